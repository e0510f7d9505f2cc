"""Language ID by cross-parsing entropy.

A bounded sample of labelled text per language becomes a suffix automaton,
which knows every substring of that sample. A text is parsed greedily into the
longest phrases that a language's sample contains; a text of that language
needs few. A byte that the sample lacks closes the phrase before it. Bits = phrases x log2(sample length) estimates the cross entropy,
and the language with the fewest bits per byte wins.

Every text is parsed whole. Each is cut into segments of ``SEGMENT`` bytes that
start a new phrase, so that all segments of a block of texts walk the automaton
side by side in numpy; a task holds one block of about ``BLOCK_CHARS``.

Defined results: a null text, a text without a letter, and any text when there
is nothing to learn from gives ``und`` with score 0. Ties go to the language
that sorts first. Repeated rows are judged one by one. The label, source and id
columns choose training rows only and are never read for a prediction.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import text_blocks

UNDETERMINED = "und"
SEGMENT = 256
#: Bytes of a text that are no part of a word are all one symbol; a run of them counts once.
_SYMBOL = np.array([b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)], np.uint8)


def training_texts(labelled: DataFrame, text: str = "text", lang: str = "lang", texts_per_language: int = 64,
                   bytes_per_language: int = 24_000, bytes_per_text: int = 2_000,
                   max_languages: int = 200) -> dict[str, bytes]:
    """Language -> sample text, whole texts chosen by the hash of their text.

    The bound: of each of at most ``max_languages`` languages at most
    ``texts_per_language`` texts, and as many of them as ``bytes_per_language`` bytes hold (about 20 of
    1,200 bytes by default), but one at least. A text's hash picks its slot; in a slot a text of at most
    ``bytes_per_text`` bytes wins over a longer one, then the smallest hash, so the choice
    does not depend on order or partitioning and copies count once.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    size = F.octet_length("text")
    best = F.min(F.struct((size > bytes_per_text).alias("long"), "h", size.alias("size")))
    slots = (rows.groupBy("lang", F.pmod("h", F.lit(texts_per_language)).alias("slot")).agg(best.alias("best"))
             .limit(texts_per_language * max_languages + 1).collect())
    if len(slots) > texts_per_language * max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    chosen, held = set(), {}
    for name, (_, h, n) in sorted((r["lang"], tuple(r["best"])) for r in slots):
        if name not in held or held[name] + n <= bytes_per_language:
            chosen.add((name, h))
            held[name] = held.get(name, 0) + n
    if not chosen:
        return {}
    picked = rows.where(F.col("h").isin([h for _, h in chosen])).select("lang", "h", "text").distinct().collect()
    out: dict[str, bytes] = {}
    for r in sorted(picked, key=lambda r: (r["lang"], r["h"])):
        if (r["lang"], r["h"]) in chosen:
            out[r["lang"]] = out.get(r["lang"], b"") + symbols(r["text"]).tobytes() + b" "
    return out


def symbols(text: str) -> np.ndarray:
    """The text in lower case as bytes; runs of non-letters become one space."""
    s = _SYMBOL[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 32) | (s[:-1] != 32)
    return s[keep]


def suffix_automaton(codes: bytes, width: int) -> np.ndarray:
    """Flat table of the automaton of all substrings: entry ``state + code`` is the
    next state, already times ``width``, or -1. State 0 is the start."""
    step: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        state = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = state
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] != length[p] + 1:
                split = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = split
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = split
                    p = link[p]
                q = split
            link[state] = q
        last = state
    flat = np.full(len(step) * width, -1, np.int32)
    for i, row in enumerate(step):
        for c, to in row.items():
            flat[i * width + c] = to * width
    return flat


@lru_cache(maxsize=1)
def _models(samples: tuple) -> tuple[np.ndarray, list]:
    """(byte -> code, automata); code 0 is a byte that no sample has. Kept per worker process."""
    seen = sorted(set(b"".join(s for _, s in samples)))
    code = np.zeros(256, np.uint8)
    code[seen] = np.arange(1, len(seen) + 1)
    return code, [suffix_automaton(code[np.frombuffer(s, np.uint8)].tobytes(), len(seen) + 1) for _, s in samples]


def phrase_counts(texts: list[np.ndarray], code: np.ndarray, automata: list[np.ndarray]) -> np.ndarray:
    """Phrases that each text needs under each automaton: array (texts, automata)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    lanes = -(-sizes // SEGMENT)
    out = np.zeros((len(texts), len(automata)))
    if not lanes.sum():
        return out
    padded = np.zeros(int(lanes.sum()) * SEGMENT, np.uint8)
    first = np.concatenate([[0], np.cumsum(lanes)])
    for t, at in zip(texts, first[:-1] * SEGMENT):
        padded[at:at + len(t)] = code[t]
    owner = np.repeat(np.arange(len(texts)), lanes)
    filled = np.full(len(owner), SEGMENT, np.int64)
    ends = first[1:][lanes > 0] - 1
    filled[ends] = (sizes[lanes > 0] - 1) % SEGMENT + 1
    order = np.argsort(-filled, kind="stable")
    columns = np.ascontiguousarray(padded.reshape(-1, SEGMENT)[order].T)
    active = np.searchsorted(-filled[order], -np.arange(1, SEGMENT + 1), side="right")
    for k, automaton in enumerate(automata):
        start = np.maximum(automaton[:int(code.max()) + 1], 0)
        state, phrases = np.zeros(len(order), np.int32), np.zeros(len(order), np.int32)
        for t in range(SEGMENT):
            n = active[t]
            if not n:
                break
            c = columns[t, :n]
            to = automaton.take(state[:n] + c)
            ended = to < 0
            phrases[:n] += ended
            state[:n] = np.where(ended, start.take(c), to)
        phrases += state != 0
        out[:, k] = np.bincount(owner[order], phrases, len(texts))
    return out


def identify(docs: DataFrame, samples: dict[str, bytes], text: str = "text", max_bits: float = math.inf,
             min_bytes: int = 32) -> DataFrame:
    """The rows with ``lang_pred``, ``lang_score`` (0 to 1) and ``lang_bits`` (per byte)
    in front of all columns of ``docs``.

    The score is the share of the winner's likelihood 2^-bits among all
    languages, the best learned one for every text with a letter. With a
    finite ``max_bits``, a text that costs more a byte in every language
    (unknown scripts, random strings) is ``und`` too, unless it is shorter than
    ``min_bytes``; prose of a learned language costs 2 to 4. New columns take the place of equally named ones.
    """
    new = ["lang_pred", "lang_score", "lang_bits"]
    rest = [c for c in docs.columns if c not in new]
    models = tuple(sorted(samples.items()))
    names = [n for n, _ in models]

    def judge(batches):
        code, automata = _models(models) if models else (None, [])
        for batch in batches:
            pred, score, bits = [], [], []
            for _, _, texts in text_blocks(batch, text):
                lettered = [bool(t) and any(map(str.isalpha, t)) for t in texts]
                parsed = [symbols(t) if has else np.empty(0, np.uint8) for t, has in zip(texts, lettered)]
                if not names:
                    pred += [UNDETERMINED] * len(texts)
                    score += [0.0] * len(texts)
                    bits += [None] * len(texts)
                    continue
                cost = phrase_counts(parsed, code, automata) * np.log2([len(s) for _, s in models])
                best = cost.argmin(axis=1)
                least = cost[np.arange(len(texts)), best]
                share = 1 / np.exp2(np.maximum(least[:, None] - cost, -1000)).sum(axis=1)
                for i, has in enumerate(lettered):
                    rate = float(least[i] / len(parsed[i])) if has else None
                    known = has and (rate <= max_bits or len(parsed[i]) < min_bytes)
                    pred.append(names[best[i]] if known else UNDETERMINED)
                    score.append(float(share[i]) if known else 0.0)
                    bits.append(rate)
            found = [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(bits, pa.float64())]
            yield pa.RecordBatch.from_arrays(found + [batch.column(batch.schema.get_field_index(c)) for c in rest], new + rest)

    kept = docs.select(*rest)
    schema = "lang_pred string, lang_score double, lang_bits double"
    return kept.mapInArrow(judge, _with(schema, kept))


def _with(front: str, df: DataFrame):
    from pyspark.sql.types import StructType
    return StructType(StructType.fromDDL(front).fields + df.schema.fields)
