"""Fill-in-the-middle transformation on UTF-8 bytes with a sparse index of exceptions.

A text is cut on its bytes, and only multibyte characters are remembered: where they stand, in
bytes and in code points, and how many bytes they have more than one. A cut inside or behind
them is converted between bytes and code points by a binary search in that index; spans without
multibyte characters need arithmetic only, and an ASCII text has an empty index.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnlens.llm.common import text_or_empty

#: Marks before the prefix, the suffix and the middle. Fixed by the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


@dataclass(frozen=True)
class Infill:
    """``unit`` is ``line`` or ``char``; rates are in percent of the texts that can be cut."""

    unit: str = "line"
    seed: str = "7"
    rate: int = 100
    spm_rate: int = 50


class ByteIndex:
    """Byte and code point places of one UTF-8 text.

    ``at`` holds the code point places of the multibyte characters, ``at_byte`` their byte
    places, and ``excess`` the sum of their bytes over one up to and including each.
    """

    def __init__(self, raw: np.ndarray):
        leads = np.flatnonzero(raw >= 0xC0)
        more = np.ones(len(leads), np.int64) + (raw[leads] >= 0xE0) + (raw[leads] >= 0xF0)
        self.at_byte, self.excess = leads, np.cumsum(more)
        self.at = leads - (self.excess - more)
        self.bytes = len(raw)

    def _before(self, places: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """The excess bytes of the multibyte characters that stand before each cut."""
        if not len(places):
            return np.zeros(np.shape(cut), np.int64)
        found = np.searchsorted(places, cut, side="left")
        return np.where(found > 0, self.excess[np.maximum(found, 1) - 1], 0)

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        return chars + self._before(self.at, chars)

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """For cuts in bytes that lie between characters."""
        return cuts - self._before(self.at_byte, cuts)

    @property
    def chars(self) -> int:
        return self.bytes - (int(self.excess[-1]) if len(self.excess) else 0)


def unit_cuts(raw: np.ndarray, index: ByteIndex, unit: str, first: int, second: int) -> tuple[int, np.ndarray]:
    """How many units the text has, and the byte places after two counts of them, drawn modulo n + 1."""
    if unit == "char":
        n = index.chars
        wanted = np.sort(np.array([first % (n + 1), second % (n + 1)], np.int64))
        return n, index.to_bytes(wanted)
    ends = np.flatnonzero(raw == 10) + 1
    if len(raw) and (not len(ends) or ends[-1] != len(raw)):
        ends = np.append(ends, len(raw))
    n = len(ends)
    wanted = np.sort(np.array([first % (n + 1), second % (n + 1)], np.int64))
    return n, np.where(wanted > 0, ends[np.maximum(wanted, 1) - 1] if n else 0, 0)


FIELDS = pa.struct(
    [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())]
)
FIELDS_SQL = "struct<n:bigint,form:string,prefix_chars:bigint,middle_chars:bigint,output:string>"
OUTPUTS = ("n", "form", "prefix_chars", "middle_chars", "output")


def transformed(text: bytes, draws: tuple[int, int, int, int], how: Infill) -> tuple:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    raw = np.frombuffer(text, np.uint8)
    index = ByteIndex(raw)
    n, cuts = unit_cuts(raw, index, how.unit, draws[0], draws[1])
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or draws[2] % 100 >= how.rate:
        return n, "plain", None, None, text
    a, b = (int(x) for x in cuts)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    chars = index.to_chars(cuts)
    spm = draws[3] % 100 < how.spm_rate
    parts = [marks[1], suffix, marks[0], prefix] if spm else [marks[0], prefix, marks[1], suffix]
    output = b"".join([*parts, marks[2], middle])
    return n, "spm" if spm else "psm", int(chars[0]), int(chars[1] - chars[0]), output


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Infill = Infill()
) -> DataFrame:
    """``docs`` with n, form, prefix_chars, middle_chars and output.

    Cuts are drawn from the SHA-256 of the seed and the id, so repeated rows are cut alike and
    no shuffle is needed; a null id counts as an empty one. ``n`` counts the units (lines, or
    code points). Null and empty texts, texts that contain a mark, and those that the rate
    leaves out are ``plain``: the output is the text, and prefix_chars and middle_chars are
    null. Very long texts are cut whole. An empty table gives an empty result. Columns of
    ``docs`` with the names of outputs are replaced, all others returned as they are.
    """
    digest = F.sha2(F.concat(F.lit(how.seed + ":"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)

    @F.arrow_udf(FIELDS_SQL)
    def cut(texts: pa.Array, digests: pa.Array) -> pa.Array:
        # Bytes, not strings: a slice of the Arrow buffer is read without decoding it.
        raw = texts.cast(pa.large_string()).cast(pa.large_binary())
        made = []
        for text, drawn in zip(raw, digests):
            h = drawn.as_py()
            draws = tuple(int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
            made.append(transformed(text.as_py(), draws, how))
        n, form, prefix, middle, output = zip(*made) if made else ((),) * 5
        columns = [
            pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
            pa.array(output, pa.large_binary()).cast(pa.string()),
        ]
        return pa.StructArray.from_arrays(columns, OUTPUTS)

    others = [F.col(f"`{c}`") for c in docs.columns if c not in OUTPUTS]
    made = docs.withColumn("fim_", cut(text_or_empty(text_col), digest)) if text_col not in OUTPUTS else None
    if made is None:
        raise ValueError(f"the text column may not have the name of an output: {text_col}")
    return made.select(*others, *[F.col("fim_").getField(c).alias(c) for c in OUTPUTS])


def restored(output: Column, form: Column) -> Column:
    """The text again, from the output and its form."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)
