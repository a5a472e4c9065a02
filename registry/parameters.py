"""Parameters shared by the Spark queries and their SQL."""

from datetime import datetime

from mediacat.sources.tables import Language, Tag

NOW = datetime(2000, 1, 1)
START = datetime(1999, 1, 1)
CURSOR = datetime(1999, 6, 1)
START_TEXT = "1999-01-01"
MAX_WORDS = 8
SAMPLE_DOCUMENTS = 300.0
SAMPLE_CONVERSATIONS = 10.0
MAX_TAGS = 2
MIN_CONFIDENCE = 0.02
LANGUAGES = [
    Language(0, "en"), Language(1, "es", 0.0), Language(2, "fr", 0.5),
    Language(3, "de", 10.0), Language(4, "pt", 0.25),
]
FEW_LANGUAGES = [Language(0, "en"), Language(1, "es"), Language(2, "fr")]
CORRECTIONS = [("the", "DER"), ("der", "la"), ("on.", "$1 on")]
TAGS = [
    Tag(0, "food", "the"), Tag(1, "travel", "of"), Tag(2, "vlog", "de"),
    Tag(3, "music", "la"), Tag(4, "news", "der"), Tag(5, "science", "that"),
]
GATEWAYS = ["https://g0.example/ipfs/", "https://g1.example/ipfs/"]


def stand_in_translation(texts, source, target):
    """Marks a text with its languages; it takes the place of a translation model."""
    return [f"[{source}>{target}] {text}" for text in texts]
