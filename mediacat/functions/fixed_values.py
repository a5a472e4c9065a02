"""Constants that decide results and are therefore stated as they are."""

# Characters removed at both ends of a text (Python's definition of whitespace).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Content-id scheme and manifest suffix in the legacy catalog.
CID_SCHEME = "ipfs://"
MANIFEST_SUFFIX = "/manifest.m3u8"

# Names and ranks of the three catalogs.
LEGACY, EMBED, AUDIO = "legacy", "embed", "audio"
WORK_TYPE_RANK = {"embed": 0, "legacy": 1, "audio": 2}
LOOKUP_RANK = {"legacy": 0, "embed": 1, "audio": 2}

# Statuses that make a video available.
PUBLISHED, SCHEDULED = "published", "scheduled"

# Cue splitting.
MAX_WORDS = 8
SENTENCE_END = "[.!?]$"

# Tagging.
MAX_TAGS = 5
MIN_CONFIDENCE = 0.3
CUSTOM_TAG_SLACK = 2
SAMPLE_SECONDS = 300
DESCRIPTION_WITH_SPEECH = 1500
TRANSCRIPT_UNSAMPLED = 1500
DESCRIPTION_ALONE = 3000
SCORE_MAP_CHARS = 3000
NO_TEXT_TAGS = ["vlog", "general"]
FAILED_TAGS = ["general", "video"]

# Fallback language of speech that is not configured.
FALLBACK_LANGUAGE = "en"

# Translation batch size.
TRANSLATION_BATCH = 32

# Monitoring feed sizes.
RECENT_PER_TYPE = 20
FEED_COMPLETED = 50
FEED_PENDING = 50
PAGE_MAX = 100

# ISO 639-1 code -> script-tagged language code, and the default.
LANGUAGE_CODES = {
    "en": "eng_Latn",
    "es": "spa_Latn",
    "fr": "fra_Latn",
    "de": "deu_Latn",
    "pt": "por_Latn",
    "ru": "rus_Cyrl",
    "ja": "jpn_Jpan",
    "zh": "zho_Hans",
    "ar": "arb_Arab",
    "hi": "hin_Deva",
    "ko": "kor_Hang",
    "it": "ita_Latn",
    "tr": "tur_Latn",
    "vi": "vie_Latn",
    "pl": "pol_Latn",
    "uk": "ukr_Cyrl",
    "nl": "nld_Latn",
    "th": "tha_Thai",
    "id": "ind_Latn",
    "bn": "ben_Beng",
    "el": "ell_Grek",
}
DEFAULT_LANGUAGE_CODE = "eng_Latn"
