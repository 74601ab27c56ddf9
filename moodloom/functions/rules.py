"""Fixed values of the cleaning and labeling rules."""

# They decide the results, so they are stated here as they are.
STOP_WORDS = (
    "a", "an", "the", "and", "or", "but", "if", "is", "it", "of", "on", "in",
    "to", "for", "with", "as", "at", "by", "from", "that", "this", "these",
    "those", "then", "there", "when", "where", "how", "why",
)
URL = r"http\S+"
RETWEET_PREFIX = r"^RT @\w+: "
POSITIVE_ABOVE = 0.5
NEGATIVE_BELOW = -0.5
METRICS = ("accuracy", "weightedPrecision", "weightedRecall", "f1")
KEYWORD_MIN_LENGTH = 5
TOP_KEYWORDS = 10
HASHED_FEATURES = 1000
TRAIN_RATIO = 0.7
SPLIT_SEED = 42

# Everything but ASCII letters, digits and whitespace. Java's \p{Alnum} is ASCII, so this is
# the class a-zA-Z0-9; spelled with ranges the same class runs about ten times slower.
NON_ALNUM = r"[^\p{Alnum}\s]"

# A run of ASCII letters and digits: a word of cleaned text.
WORD = r"\p{Alnum}+"

# Whitespace as Python's str.split() sees it: Unicode spaces and four separator controls.
ANY_SPACE = r"(?U)[\s\x1c-\x1f]+"
