"""Fill-in-the-middle rearrangement, cut by a learned index of token boundaries.

A text's tokens are runs of white space with the word that follows; n tokens have
n + 1 boundaries. The offset (in code points) of boundary k is learned: straight
segments run through the boundaries so that none is further than ``error`` from
its segment, and what is left of each is kept in one byte. The offset of a cut is
the segment's value plus that byte, so it is exact. Segments are made greedily:
a segment goes on as long as some slope through its first boundary fits all.

The index of a text is a struct of arrays, made once (:func:`boundary_index`) and
good for any number of cuts; the cuts themselves, the rearrangement and the way
back are Column expressions. A text that holds one of the three marks stays plain,
so marks in an output are always the transformation's own.

Defined results
    null or empty text    plain, empty
    very long text        whole; its index takes one byte a token and 20 a segment
    repeated rows         each gets its row; equal ids and texts have equal outputs
    null id               hashed as the empty string
    empty table           no rows
    extra columns         kept; the result's columns get longer names where they clash
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.llm.common import BLANKS, fresh

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Rounding adds one at most, so that residuals stay within a signed byte.
ERROR = 126
INDEX_TYPE = "n int, start array<int>, offset array<int>, slope array<double>, residual array<tinyint>"

_BLANK = np.array([ord(c) for c in BLANKS], np.uint32)


def boundaries(text: str) -> np.ndarray:
    """Offsets 0, ..., len(text) at which tokens ``[blanks]*[non-blanks]+|[blanks]+`` begin and end."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = np.isin(chars, _BLANK)
    # A token ends where a word does; blanks at the end of the text are a token of their own.
    ends = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    return np.concatenate([[0], ends, [len(chars)]]) if len(chars) else np.zeros(1, np.int64)


def fit(offsets: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """Ranks at which segments start, and their slopes."""
    starts, slopes = [], []
    at, n = 0, len(offsets)
    while at < n:
        low, high, slope, end, step = -np.inf, np.inf, 0.0, at + 1, 256
        while end < n:
            window = np.arange(end, min(n, end + step))
            run, rise = window - at, offsets[window] - offsets[at]
            lows = np.maximum(low, np.maximum.accumulate((rise - error) / run))
            highs = np.minimum(high, np.minimum.accumulate((rise + error) / run))
            open_ = int(np.argmax(lows > highs)) if lows[-1] > highs[-1] else len(window)
            if open_:
                low, high = lows[open_ - 1], highs[open_ - 1]
                slope = (low + high) / 2
            end += open_
            if open_ < len(window):
                break
            step *= 2
        starts.append(at)
        slopes.append(slope)
        at = end
    return np.array(starts, np.int32), np.array(slopes)


def predict(rank: np.ndarray, starts: np.ndarray, first: np.ndarray, slopes: np.ndarray) -> np.ndarray:
    k = np.searchsorted(starts, rank, side="right") - 1
    return first[k] + np.floor(slopes[k] * (rank - starts[k]) + 0.5).astype(np.int64)


def boundary_index(text: Column, error: int = ERROR) -> Column:
    """The learned index of a text: a struct of :data:`INDEX_TYPE`."""
    if not 0 <= error <= ERROR:
        raise ValueError(f"error must be 0 to {ERROR}: residuals are kept in one byte")

    @F.pandas_udf(INDEX_TYPE)
    def learn(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            offsets = boundaries(t)
            starts, slopes = fit(offsets, error)
            first = offsets[starts]
            left = offsets - predict(np.arange(len(offsets)), starts, first, slopes)
            rows.append((len(offsets) - 1, starts, first.astype(np.int32), slopes, left.astype(np.int8)))
        return pd.DataFrame(rows, columns=["n", "start", "offset", "slope", "residual"])

    return learn(F.coalesce(text, F.lit("")))


def offset_of(index: Column, rank: Column) -> Column:
    """The exact offset of boundary ``rank``: the value of its segment and what that is off by."""
    k = F.size(F.filter(index["start"], lambda s: s <= rank)) - 1
    step = (rank - F.get(index["start"], k)).cast("double")
    return F.get(index["offset"], k) + F.floor(F.get(index["slope"], k) * step + 0.5) + F.get(index["residual"], rank.cast("int"))


def fill_in_middle(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rate: int = 50,
    spm_rate: int = 80,
    seed: str = "42",
    error: int = ERROR,
) -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output`` (longer names where ``docs`` has them).

    ``rate`` percent of texts are rearranged, ``spm_rate`` percent of those with the suffix first. All choices follow from
    the hash of seed and id.
    """
    names = {c: fresh(docs, c) for c in ("n", "form", "prefix_chars", "middle_chars", "output")}
    index, first, second, digest, text = (fresh(docs, c) for c in ("_index", "_first", "_second", "_digest", "_text"))
    h = [F.conv(F.substring(F.col(digest), 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    n = F.col(index)["n"]
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    made = docs.withColumns({text: F.coalesce(text_col, F.lit("")), digest: F.sha2(key, 256)})
    made = made.withColumn(index, boundary_index(F.col(text), error))
    cuts = [h[k] % (n + 1) for k in (0, 1)]
    made = made.withColumns({first: offset_of(F.col(index), F.least(*cuts)), second: offset_of(F.col(index), F.greatest(*cuts))})
    marked = F.col(text).contains(PREFIX) | F.col(text).contains(SUFFIX) | F.col(text).contains(MIDDLE)
    plain = (F.col(text) == "") | marked | (h[2] % 100 >= rate)
    form = F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm")
    prefix = F.substring(F.col(text), F.lit(1), F.col(first).cast("int"))
    middle = F.substring(F.col(text), F.col(first).cast("int") + 1, (F.col(second) - F.col(first)).cast("int"))
    suffix = F.substring(F.col(text), F.col(second).cast("int") + 1, F.lit((1 << 31) - 1))
    p, s, m = map(F.lit, (PREFIX, SUFFIX, MIDDLE))
    made = made.withColumns({names["n"]: n.cast("long"), names["form"]: form})
    is_plain, spm = F.col(names["form"]) == "plain", F.col(names["form"]) == "spm"
    output = F.when(is_plain, F.col(text)).when(spm, F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.concat(p, prefix, s, suffix, m, middle))
    made = made.withColumns(
        {
            names["prefix_chars"]: F.when(~is_plain, F.col(first)).cast("long"),
            names["middle_chars"]: F.when(~is_plain, F.col(second) - F.col(first)).cast("long"),
            names["output"]: output,
        }
    )
    return made.drop(index, first, second, digest, text)


def restore(output: Column, form: Column) -> Column:
    """The text again, from output and form alone. The marks are the transformation's own: marked texts stay plain."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)  # nothing, two parts in the form's order, the middle
    spm = form == "spm"
    prefix, suffix = F.when(spm, F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1))), F.when(spm, F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))
