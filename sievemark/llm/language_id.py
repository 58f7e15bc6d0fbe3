"""Language identification with a small byte convolutional network, trained here in numpy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.common import per_text

WINDOW = 128  # bytes of a window
WIDTHS = (2, 3, 4)  # bytes a filter spans
FILTERS = 12  # filters of each width
EMBED = 8
OVERLAP = max(WIDTHS) - 1
UNDETERMINED = "und"


def has_letter(text: str) -> bool:
    """Whether any character is a letter by its Unicode category; digits, fractions and enclosed numbers are none."""
    return any(map(str.isalpha, text))


def folded(text: bytes) -> bytes:
    """Lower-cased UTF-8: capitals should not make a language."""
    return text.decode("utf-8", "replace").lower().encode("utf-8")


def cut(data: bytes) -> np.ndarray:
    """Windows of ``WINDOW`` bytes that share ``OVERLAP`` bytes with the next, the last zero-filled."""
    step = WINDOW - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.zeros(n * step + OVERLAP, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::step]


@dataclass
class ByteNetwork:
    """Bytes -> filters of several widths -> max over the window -> softmax.

    Filters work on an embedding of bytes; both are multiplied out into ``table``, one row per
    byte and one column per (offset in the filter, filter), offsets in the outer order.
    A filter's response at a place is then the sum of a few table entries.
    """

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def responses(self, windows: np.ndarray) -> np.ndarray:
        return responses(self.table, windows)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        pooled = np.maximum(self.responses(windows).max(axis=1) + self.bias, 0)
        return softmax(pooled @ self.weights + self.offset)

    def predict(self, text: bytes | None, at_once: int = 64) -> tuple[str, float]:
        """Language and its mean probability over the windows, weighted by their bytes."""
        if text is None or not self.languages or not has_letter(text.decode("utf-8", "replace")):
            return UNDETERMINED, 0.0
        data = folded(text)
        windows = cut(data)
        total = np.zeros(len(self.languages))
        for i in range(0, len(windows), at_once):
            part = windows[i : i + at_once]
            total += (part != 0).sum(axis=1) @ self.probabilities(part)
        best = int(total.argmax())
        return self.languages[best], float(min(1.0, total[best] / max(total.sum(), 1e-300)))


def _layout() -> list[tuple[int, int]]:
    """(first filter, number of filters) that have the offset 0, 1, ... in their width."""
    return [(i := sum(w <= k for w in WIDTHS) * FILTERS, len(WIDTHS) * FILTERS - i) for k in range(max(WIDTHS))]


def responses(table: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(windows, places, filters)."""
    taken, places, column = table[windows], WINDOW - OVERLAP, 0
    out = None
    for k, (first, n) in enumerate(_layout()):
        part = taken[:, k : k + places, column : column + n]
        column += n
        if out is None:
            out = part.copy()
        else:
            out[:, :, first:] += part
    return out


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[bytes, str]], steps: int = 1500, batch: int = 96, rate: float = 0.01, seed: int = 7) -> ByteNetwork:
    """Fit the network on (text, language) pairs with Adam; each step draws random windows,
    many of them short, and every language equally often."""
    languages = sorted({lang for _, lang in samples})
    random = np.random.default_rng(seed)
    wide = len(WIDTHS) * FILTERS
    columns = sum(n for _, n in _layout())
    p = {
        "embed": random.normal(0, 0.5, (256, EMBED)),
        "conv": random.normal(0, 0.3, (EMBED, columns)),
        "bias": np.zeros(wide),
        "weights": random.normal(0, 0.1, (wide, len(languages))),
        "offset": np.zeros(len(languages)),
    }
    if len(languages) > 1:
        texts: dict[str, list[bytes]] = {x: [] for x in languages}
        for text, lang in samples:
            if data := folded(text):
                texts[lang].append(data)
        _descend(p, [texts[x] for x in languages], random, steps, batch, rate)
    table = (p["embed"] @ p["conv"]).astype(np.float32)
    table[0] = 0
    return ByteNetwork(languages, table, *(p[k].astype(np.float32) for k in ("bias", "weights", "offset")))


def _descend(p: dict, texts: list[list[bytes]], random: np.random.Generator, steps: int, batch: int, rate: float) -> None:
    usable = [i for i, own in enumerate(texts) if own]
    mean = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    rows = np.arange(batch)
    for step in range(1, steps + 1):
        windows, wanted = np.zeros((batch, WINDOW), np.uint8), random.choice(usable, batch)
        for r, lang in enumerate(wanted):
            data = texts[lang][random.integers(len(texts[lang]))]
            size = min(len(data), WINDOW if r % 2 else int(random.integers(8, WINDOW)))
            start = int(random.integers(len(data) - size + 1))
            windows[r, :size] = np.frombuffer(data, np.uint8, size, start)
        table = p["embed"] @ p["conv"]
        table[0] = 0
        found = responses(table, windows)
        place = found.argmax(axis=1)
        top = np.take_along_axis(found, place[:, None, :], 1)[:, 0] + p["bias"]
        pooled = np.maximum(top, 0)
        error = softmax(pooled @ p["weights"] + p["offset"])
        error[rows, wanted] -= 1
        error /= batch
        back = (error @ p["weights"].T) * (top > 0)
        d_table, column = np.zeros_like(table), 0
        for k, (first, n) in enumerate(_layout()):
            byte = windows[rows[:, None], place[:, first:] + k]
            np.add.at(d_table, (byte, np.arange(column, column + n)[None, :]), back[:, first:])
            column += n
        d_table[0] = 0
        slope = {
            "embed": d_table @ p["conv"].T, "conv": p["embed"].T @ d_table, "bias": back.sum(0),
            "weights": pooled.T @ error, "offset": error.sum(0),
        }
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in slope.items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            p[k] -= pace * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)


def training_sample(labelled: DataFrame, text: str, lang: str, key: str, docs_per_language: int = 400, parts: int = 4, part_chars: int = 400) -> list[tuple[bytes, str]]:
    """A bounded sample: about ``docs_per_language`` documents of each language (chosen by a hash of
    ``key``, never over twice as many in all), ``parts`` pieces of ``part_chars`` characters of each."""
    known = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    sizes = {r[lang]: r["n"] for r in known.groupBy(lang).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return []
    draw = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share: Column = F.coalesce(*[F.when(F.col(lang) == x, F.lit(docs_per_language / n)) for x, n in sizes.items()], F.lit(0.0))
    span = F.greatest(F.length(text) - part_chars, F.lit(0)) + 1
    pieces = F.array(*[F.substring(F.col(text), (F.pmod(F.xxhash64(F.lit(i), key), span) + 1).cast("int"), F.lit(part_chars)) for i in range(parts)])
    rows = known.filter(draw < share).limit(2 * docs_per_language * len(sizes)).select(lang, pieces.alias("pieces")).collect()
    return [(piece.encode(), r[lang]) for r in sorted(rows, key=lambda r: (r[lang], r["pieces"])) for piece in r["pieces"]]


def with_language(docs: DataFrame, model: ByteNetwork, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score``; ``und`` and 0 for a null text or one without a letter.

    Whole texts count, window by window. Nothing but the text enters a prediction, so copies
    agree. With a model of no language (nothing to learn from) every text is ``und``.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[bytes | None], tuple]:
        return sent.value.predict

    return per_text(docs, text, make, "lang_pred string, score double", keep)
