"""Fixed values of the oracle: vocabularies, limits and labels of the contract and of the test mapping, stated on their own."""

EPOCH_DAY_2015_01_01 = 16436
EPOCH_DAY_2018_01_01 = 17532
GENDERS = ['Female', 'Male', 'Other', 'Prefer not to say']
GENRES_BY_PART_TYPE = {'ECONOMY': 'Drama', 'LARGE': 'Action', 'MEDIUM': 'Comedy', 'PROMO': 'Documentary', 'SMALL': 'Horror', 'STANDARD': 'Romance'}
LANGUAGES = ['English', 'Spanish', 'Korean', 'Hindi']
NS_PER_DAY = 86400000000000
NS_PER_SECOND = 1000000000
ORIGIN_COUNTRIES = ['USA', 'UK', 'India', 'South Korea']
PREVIOUS_SNAPSHOT_DATE = '2026-03-27'
SECONDARY_GENRES = ['Thriller', 'Sci-Fi', 'Family', 'Crime']
SESSION_COUNTRIES = ['USA', 'Canada', 'USA', 'Mexico']
SNAPSHOT_DATE = '2026-03-28'
UNCATALOGUED_OFFSET = 1000000000
AGE_BUCKETS = ['Gen Z (< 25)', 'Millennial (25–34)', 'Gen X (35–49)', 'Boomer+ (50+)', 'Unknown']
AGE_RATINGS = ['G', 'PG', 'PG-13', 'R', 'NC-17', 'TV-G', 'TV-PG', 'TV-14', 'TV-MA', 'TV-Y', 'TV-Y7']
CONTENT_TYPES = ['Movie', 'TV Series', 'Documentary', 'Limited Series', 'Stand-up Comedy']
CONVERSION_WINDOW_DAYS = 7
COUNTRIES = ['USA', 'Canada']
DEVICES = ['Smart TV', 'Mobile', 'Laptop', 'Desktop', 'Tablet']
PRIMARY_KEYS = {'movies': ['movie_id'],
 'users': ['user_id'],
 'watch_history': ['session_id'],
 'reviews': ['review_id'],
 'recommendation_logs': ['recommendation_id'],
 'search_logs': ['search_id']}
PROFILE_MAX_DISTINCT = 30
QUALITIES = ['SD', 'HD', '4K', 'Ultra HD']
RECOMMENDATION_TYPES = ['personalized', 'genre_based', 'trending', 'similar_users', 'new_releases']
REVIEW_RATINGS = [1, 2, 3, 4, 5]
SEARCH_OUTCOMES = ['zero_results', 'no_click', 'top_3_click', 'lower_click']
SENTIMENTS = ['positive', 'neutral', 'negative']
SINGLE_TITLE_TYPES = ['Movie', 'Stand-up Comedy', 'Documentary']
SUBSCRIPTION_PLANS = ['Basic', 'Standard', 'Premium', 'Premium+']
TABLES = ('movies', 'users', 'watch_history', 'reviews', 'recommendation_logs', 'search_logs')
TIMES_OF_DAY = ['morning', 'afternoon', 'evening', 'night']
WATCH_ACTIONS = ['started', 'paused', 'stopped', 'completed']
