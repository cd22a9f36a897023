"""Column-level functions (scalar and array expressions)."""

from .hashing import split_part, term_bucket  # noqa: F401
from .stopwords import ENGLISH_STOP_WORDS  # noqa: F401
from .text import (clean_text, java_trim, strip_punctuation, tokens,  # noqa: F401
                   without_stop_words)
