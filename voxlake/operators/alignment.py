"""Word times from frame-wise symbol probabilities."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from voxlake.functions.text import UNSPACED_LANGUAGES
from voxlake.operators.signal import ctc_align

LEAST_WINDOW = 0.1  # seconds


def _spelled(words: list[str], symbol: Callable[[str], int | None], delimiter: int | None) -> tuple[list[int], np.ndarray]:
    """Symbols of words with delimiters between them, and the word of each (-1 for delimiters)."""
    tokens, owner = [], []
    for k, word in enumerate(words):
        known = [s for s in map(symbol, word) if s is not None]
        if known and tokens and delimiter is not None:
            tokens.append(delimiter)
            owner.append(-1)
        tokens += known
        owner += [k] * len(known)
    return tokens, np.array(owner, np.int64)


def _windows(segments: list[tuple[float, float, str]], k: int, total: float, pad: float) -> Iterator[tuple[float, float]]:
    """A segment's own span, then that up to its neighbours, both with a margin."""
    start, end, _ = segments[k]
    before = segments[k - 1][1] if k else 0.0
    after = segments[k + 1][0] if k + 1 < len(segments) else total
    for a, b in ((start, end), (min(start, before), max(end, after))):
        yield max(0.0, a - pad), min(total, b + pad)


def align_segments(
    segments: list[tuple[float, float, str]], total: float, emissions: Callable[[float, float], np.ndarray], symbol: Callable[[str], int | None], blank: int, delimiter: int | None = None, language: str = "", pad: float = 0.2
) -> tuple[list[tuple[str, float, float, float]], int]:
    """Words (text, start, end, probability) of segments (start, end, text), and how many segments didn't fit.

    ``emissions`` gives log-probabilities (frames x symbols) of the audio between two times. A segment whose text doesn't fit
    into its own span is tried once more with that up to its neighbours; words without any known symbol are left out.
    """
    space = "" if language.split("-")[0] in UNSPACED_LANGUAGES else " "
    found, failed = [], 0
    for k, (_, _, text) in enumerate(segments):
        words = text.split()
        if not words:
            continue
        tokens, owner = _spelled(words, symbol, delimiter)
        frames = None
        for a, b in _windows(segments, k, total, pad):
            if b - a < LEAST_WINDOW:
                break
            log_probs = emissions(a, b)
            frames = ctc_align(log_probs, tokens, blank)
            if frames is not None:
                break
        if frames is None:
            failed += 1
            continue
        at, step = np.array(frames), (b - a) / len(log_probs)
        sure = np.exp(log_probs[at, np.array(tokens)])
        for w in np.unique(owner[owner >= 0]).tolist():
            mine = owner == w
            found.append((space + words[w], round(a + at[mine].min() * step, 3), round(a + (at[mine].max() + 1) * step, 3), float(sure[mine].mean())))
    return sorted(found, key=lambda x: x[1]), failed
