"""Fill-in-middle transformation of whole texts as a pyarrow.compute pipeline.

A text is cut into lines (a line keeps its line break).  Two deterministic draws choose the cuts
between prefix, middle and suffix, one draw whether the text is transformed and one the order:
psm is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, spm is ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.
Draws come from sha256 of seed and id, computed by Spark; they do not depend on partitions.

Every batch is worked through in slices of bounded bytes: split into list arrays, flatten with parent
indices, number the units inside their parent, filter by role, rebuild lists, join.

Defined cases: null reads as the empty text; empty texts and texts that contain a sentinel stay as they are
(form plain, no character counts); a null id draws like the empty id; repeated rows with one id get one
result; a text may be of any length below 2 GB (one long text is one slice); an empty table gives an empty
table; extra columns are kept, a column named like the result is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, whole_text

SEED = 7
SENTINELS = ("<P>", "<S>", "<M>")  # prefix, suffix, middle
SLICE_BYTES = 8 << 20
RESULT = "struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:string>"
_TEXT = pa.large_string()


def draws(id_col: str, seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers of a row: the first four 8-digit groups of sha256('seed:id')."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def _check(sentinels: tuple) -> None:
    """A sentinel that overlaps itself could be found too early across the border to a piece of text."""
    for s in sentinels:
        if not s or any(s.endswith(s[:i]) for i in range(1, len(s))):
            raise ValueError(f"sentinel {s!r} is empty or overlaps itself")
    if len(set(sentinels)) != 3:
        raise ValueError("three different sentinels are needed")


def _slices(batch: pa.RecordBatch, at: int):
    """The batch in runs of rows of about ``SLICE_BYTES`` of text, one row at least."""
    ends = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield batch.slice(start, end - start)
        start = end


def _units(text: pa.Array) -> tuple:
    """(units, parent row of each, number of each inside its row, units of each row)."""
    pieces = pc.split_pattern(text, "\n")
    flat, parent = pc.list_flatten(pieces), pc.list_parent_indices(pieces)
    count = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    row = parent.to_numpy(zero_copy_only=False)
    ordinal = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    last = ordinal == count[row] - 1
    broken = pc.if_else(pa.array(last), pa.scalar("", _TEXT), pa.scalar("\n", _TEXT))
    units = pc.binary_join_element_wise(flat, broken, pa.scalar("", _TEXT))
    # what follows the last line break is a unit unless it is empty
    real = ~last | (pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0)
    return units.filter(pa.array(real)), row[real], ordinal[real], np.bincount(row[real], minlength=len(text))


def _join(units: pa.Array, row: np.ndarray, chosen: np.ndarray, rows: int) -> pa.Array:
    """The chosen units of every row put together again."""
    ends = np.cumsum(np.bincount(row[chosen], minlength=rows))
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), units.filter(pa.array(chosen)))
    return pc.binary_join(lists, pa.scalar("", _TEXT))


def _transform(text: pa.Array, h: list, percent: int, spm_percent: int, sentinels: tuple) -> pa.StructArray:
    text = text.cast(_TEXT)
    rows = len(text)
    units, row, ordinal, n = _units(text)
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    low, high = np.minimum(a, b), np.maximum(a, b)
    prefix = _join(units, row, ordinal < low[row], rows)
    middle = _join(units, row, (ordinal >= low[row]) & (ordinal < high[row]), rows)
    suffix = _join(units, row, ordinal >= high[row], rows)
    plain = pc.equal(pc.binary_length(text), 0)
    for s in sentinels:
        plain = pc.or_(plain, pc.match_substring(text, s))
    plain = pc.or_(plain, pa.array(h[2] % 100 >= percent))
    spm = pa.array(h[3] % 100 < spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    p, s, m = (pa.scalar(x, _TEXT) for x in sentinels)
    nothing = pa.scalar("", _TEXT)
    whole = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing),
                       pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing))
    none = pa.scalar(None, pa.int64())
    return pa.StructArray.from_arrays(
        [pa.array(n.astype(np.int64)), form.cast(pa.string()), pc.if_else(plain, none, pc.utf8_length(prefix).cast(pa.int64())),
         pc.if_else(plain, none, pc.utf8_length(middle).cast(pa.int64())), pc.if_else(plain, text, whole).cast(pa.string())],
        names=["n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", out: str = "fim", seed: int = SEED,
              percent: int = 100, spm_percent: int = 50, sentinels: tuple = SENTINELS) -> DataFrame:
    """All columns plus the struct ``out``: n (units), form, prefix_chars, middle_chars, output.
    ``percent`` of the documents are transformed, ``spm_percent`` of those in spm order."""
    _check(sentinels)
    df, names = docs, []
    for base, column in zip(("__h1", "__h2", "__h3", "__h4", "__whole"), [*draws(id_col, seed), whole_text(text_col)]):
        names.append(fresh(df, base))
        df = df.withColumn(names[-1], column)
    at = [df.columns.index(c) for c in names]

    def run(frames):
        for batch in frames:
            for part in _slices(batch, at[-1]):
                h = [part.column(i).to_numpy(zero_copy_only=False) for i in at[:4]]
                made = _transform(part.column(at[-1]), h, percent, spm_percent, sentinels)
                kept = [(c, part.column(i)) for i, c in enumerate(part.schema.names) if i not in at and c.lower() != out.lower()]
                yield pa.RecordBatch.from_arrays([x for _, x in kept] + [made], names=[c for c, _ in kept] + [out])

    fields = [T.StructField(f.name, f.dataType, True) for f in docs.schema.fields if f.name.lower() != out.lower()]
    return df.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StructType.fromDDL(RESULT[7:-1]))]))


def _restore(output: pa.Array, form: pa.Array, sentinels: tuple) -> pa.Array:
    """Sentinels stand in known order and occur nowhere else, so each is found at its first occurrence."""
    output, (p, s, m) = output.cast(_TEXT), sentinels
    done, order = [], []
    for name, (first, second) in {"psm": (p, s), "spm": (s, p), "plain": (None, None)}.items():
        here = np.flatnonzero(pc.equal(form, name).to_numpy(zero_copy_only=False))
        part = output.take(pa.array(here))
        if first and len(here):
            head = pc.split_pattern(pc.utf8_slice_codeunits(part, len(first)), second, max_splits=1)
            tail = pc.split_pattern(pc.list_element(head, 1), m, max_splits=1)
            pieces = [pc.list_element(head, 0), pc.list_element(tail, 0), pc.list_element(tail, 1)]
            prefix, suffix, middle = pieces if name == "psm" else (pieces[1], pieces[0], pieces[2])
            part = pc.binary_join_element_wise(prefix, middle, suffix, pa.scalar("", _TEXT))
        done.append(part)
        order.append(here)
    back = np.argsort(np.concatenate(order), kind="stable")
    return pa.chunked_array(done, _TEXT).combine_chunks().take(pa.array(back)).cast(pa.string())


def restore(df: DataFrame, fim: str = "fim", out: str = "text", sentinels: tuple = SENTINELS) -> DataFrame:
    """All columns plus ``out``: the text, rebuilt from output and form alone."""
    _check(sentinels)
    whole, form = fresh(df, "__output"), fresh(df, "__form")
    wide = df.withColumns({whole: F.col(f"{fim}.output"), form: F.col(f"{fim}.form")})
    at = [wide.columns.index(whole), wide.columns.index(form)]

    def run(frames):
        for batch in frames:
            for part in _slices(batch, at[0]):
                text = _restore(part.column(at[0]), part.column(at[1]), sentinels)
                kept = [(c, part.column(i)) for i, c in enumerate(part.schema.names) if i not in at and c.lower() != out.lower()]
                yield pa.RecordBatch.from_arrays([x for _, x in kept] + [text], names=[c for c, _ in kept] + [out])

    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields if f.name.lower() != out.lower()]
    return wide.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.StringType())]))


# The same in DuckDB.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
             greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high FROM u),
p AS (SELECT *, array_to_string(units[1:low], '') AS pre, array_to_string(units[low + 1:high], '') AS mid,
             array_to_string(units[high + 1:n], '') AS suf,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(pre || mid || suf) AS restored_sha256
FROM p
"""
