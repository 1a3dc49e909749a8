"""Operator 12: fill-in-the-middle examples from whole texts, as one pipeline of ``pyarrow.compute`` calls per batch.

Texts become lists of units (lines with their line break); the lists are flattened with the number of the text each unit came from,
a unit's ordinal in its text decides its role, and the units of a role are gathered into lists again, which ``binary_join`` makes one
string per text. No call is made per text or unit. Batches are cut into slices of ``SLICE_BYTES`` of text, so memory follows a
slice or the longest single text. The step needs no shuffle.

Two cuts, drawn from the id alone, end the prefix and the middle. ``psm`` is prefix, suffix, middle, ``spm`` suffix, prefix, middle,
each behind its mark. A text that is empty or has a mark in it stays as it is (``plain``), so the marks of the other forms are the
only ones and ``restored_texts`` finds the text again.

Cases: a null text is the empty one; a null id draws like the empty text; repeated rows give equal rows; other columns are not read;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from linecross.llm.common import byte_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SLICE_BYTES = 1 << 22
EXAMPLES = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _beside(*parts: pa.Array | str) -> pa.Array:
    """Strings of each row, one after the other; constants between them are given as ``str``."""
    return pc.binary_join_element_wise(*(pa.scalar(p, pa.large_string()) if isinstance(p, str) else p for p in parts),
                                       pa.scalar("", pa.large_string()))


def text_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Lines with their breaks, the number of the text of each, and its ordinal there."""
    lists = pc.split_pattern(texts, "\n")
    pieces, parent = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
    ends = np.cumsum(pc.list_value_length(lists).to_numpy())
    last = np.zeros(len(pieces), bool)
    last[ends - 1] = True
    units = pc.if_else(pa.array(last), pieces, _beside(pieces, "\n"))
    whole = pc.greater(pc.binary_length(units), 0)  # behind a closing line break there is no unit
    units, parent = units.filter(whole), parent[whole.to_numpy(zero_copy_only=False)]
    firsts = np.searchsorted(parent, np.arange(len(texts)))
    return units, parent, np.arange(len(parent)) - firsts[parent]


def joined(units: pa.Array, parent: np.ndarray, chosen: np.ndarray, n: int) -> pa.Array:
    """The chosen units of each of ``n`` texts as one string."""
    offsets = np.searchsorted(parent[chosen], np.arange(n + 1)).astype(np.int64)
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), units.filter(pa.array(chosen))),
                          pa.scalar("", pa.large_string()))


def _examples(batch: pa.RecordBatch, rate: int, spm: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    h = [batch.column(f"h{k}").to_numpy() for k in range(1, 5)]
    units, parent, ordinal = text_units(texts)
    n = np.bincount(parent, minlength=len(texts))
    first, second = np.minimum(h[0] % (n + 1), h[1] % (n + 1)), np.maximum(h[0] % (n + 1), h[1] % (n + 1))
    in_prefix, in_suffix = ordinal < first[parent], ordinal >= second[parent]
    prefix, suffix, middle = (joined(units, parent, chosen, len(texts)) for chosen in (in_prefix, in_suffix, ~in_prefix & ~in_suffix))
    marked = [pc.match_substring(texts, mark) for mark in (PREFIX, SUFFIX, MIDDLE)]
    plain = pc.or_(pc.or_(pc.or_(*marked[:2]), marked[2]), pa.array((n == 0) | (h[2] % 100 >= rate)))
    form = pc.if_else(plain, "plain", pc.if_else(pa.array(h[3] % 100 < spm), "spm", "psm"))
    rearranged = pc.if_else(pc.equal(form, "spm"), _beside(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle),
                            _beside(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))
    output = pc.if_else(plain, texts, rearranged)
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(part).cast(pa.int64())) for part in (prefix, middle)]
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), form, *chars, output.cast(pa.string())],
                                      [c.split()[0] for c in EXAMPLES.split(", ")])


def fill_in_middle(docs: DataFrame, rate: int = 100, spm: int = 50) -> DataFrame:
    """One example per document: ``rate`` of 100 are rearranged, ``spm`` of 100 of these with the suffix first."""
    drawn = docs.selectExpr("doc_id", "text", "sha2(concat('7:', coalesce(cast(doc_id AS string), '')), 256) AS _drawn").selectExpr(
        "doc_id", "text", *[f"cast(conv(substr(_drawn, {8 * k + 1}, 8), 16, 10) AS bigint) AS h{k + 1}" for k in range(4)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                yield _examples(part, rate, spm)
    return drawn.mapInArrow(run, EXAMPLES)


def _restored(outputs: pa.Array, forms: pa.Array) -> pa.Array:
    """The texts, each from its output and form alone."""
    outputs, plain = outputs.cast(pa.large_string()), pc.equal(forms, "plain")
    unmarked = outputs
    for mark in (PREFIX, SUFFIX):
        unmarked = pc.replace_substring(unmarked, mark, MIDDLE)
    # A mark, a part, a mark, a part, a mark, a part; plain texts get parts that are not used.
    parts = pc.split_pattern(pc.if_else(plain, pa.scalar(3 * MIDDLE, pa.large_string()), unmarked), MIDDLE)
    first, second, middle = (pc.list_element(parts, k) for k in (1, 2, 3))
    spm = pc.equal(forms, "spm")
    whole = _beside(pc.if_else(spm, second, first), middle, pc.if_else(spm, first, second))
    return pc.if_else(plain, outputs, whole).cast(pa.string())


def restored_texts(examples: DataFrame) -> DataFrame:
    """``examples`` with the text rebuilt from ``output`` and ``form`` as ``restored``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch, "output", SLICE_BYTES):
                yield part.append_column("restored", _restored(part.column("output"), part.column("form")))
    return examples.mapInArrow(run, StructType([*examples.schema, StructField("restored", StringType())]))
