"""Stop-word lists by language: plain values, so nothing is opened or looked up at import."""

from __future__ import annotations

from vitrine.config import STOP_WORDS_EN, STOP_WORDS_PT

_LISTS = {"portuguese": STOP_WORDS_PT, "english": STOP_WORDS_EN}


def stop_words(language: str = "portuguese") -> tuple:
    return _LISTS[language]
