from warband.functions.casts import (  # noqa: F401
    lenient_int, strict_double, win_flag, word_match, short_id, elapsed_seconds,
)
