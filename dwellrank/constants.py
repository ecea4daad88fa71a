"""The thresholds, patterns and labels that decide the results."""

# Stop ids of the scored city, and the station part of a stop id.
CITY_PREFIX = "de:11000:"
STATION_PATTERN = r"(de:\d+:\d+)"

# Nightly prices outside this closed range are treated as missing.
MIN_PRICE = 10
MAX_PRICE = 1000

# Areas with fewer priced listings than this get no value score.
MIN_LISTINGS = 30

# Delays in seconds: at or beyond the noise limit they are dropped,
# up to the on-time limit (inclusive) they count as on time.
NOISE_SECONDS = 7200
ON_TIME_SECONDS = 60

# Weights of value, connectivity and events in the final score.
DEFAULT_WEIGHTS = (0.5, 0.5, 0.0)

# Percentile cut-offs and labels of the area types.
HIGH_PERCENTILE = 0.6
LOW_PERCENTILE = 0.4
HIDDEN_GEM = "Hidden Gem"
PREMIUM = "Premium / Central"
BUDGET = "Budget / Remote"
BALANCED = "Balanced"
AREA_TYPES = (HIDDEN_GEM, PREMIUM, BUDGET, BALANCED)

# Placeholder texts.
OTHER_CATEGORY = "Other"
NO_STOP_ID = "(no stop_id)"
NO_DELAY = "(no delay)"

# Columns kept of a raw listing, in output order.
LISTING_COLUMNS = (
    "id",
    "latitude",
    "longitude",
    "neighbourhood_cleansed",
    "neighbourhood_group_cleansed",
    "room_type",
    "property_type",
    "accommodates",
    "bedrooms",
    "price",
    "review_scores_rating",
    "review_scores_location",
    "number_of_reviews",
    "estimated_occupancy_l365d",
    "estimated_revenue_l365d",
)

# Mean earth radius in kilometres (IUGG).
EARTH_RADIUS_KM = 6371.0088
