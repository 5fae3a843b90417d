"""Fill-in-middle transformation, in DuckDB SQL on Arrow batches.

Each batch is registered as a table and rewritten by one statement, so no row passes through Python. Cuts and forms
depend on the document's id and the seed alone, so a lost task gives the same rows again.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import ship, text_or_empty

SEED, RATE, SPM_SHARE, MARKERS = 7, 100, 50, ("<P>", "<S>", "<M>")
#: Bytes of text that one statement works on; a longer text has one of its own.
ROUND_BYTES = 4 << 20
COLUMNS = {
    "n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string", "output_sha256": "string", "restored": "string", "restored_sha256": "string",
}


def literal(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fim_sql(columns: list[str], source: str, seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE, markers: tuple[str, str, str] = MARKERS) -> str:
    """DuckDB SQL: doc_id and columns of the rewritten rows of source(doc_id, text)."""
    p, s, m = map(literal, markers)
    ends = [len(x) + 1 for x in markers]
    group = lambda k: f"('0x' || substr(h, {8 * k + 1}, 8))::UBIGINT"
    return f"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units FROM {source}
), drawn AS (
  SELECT *, len(units) AS n, ({group(0)} % (len(units) + 1))::BIGINT AS a, ({group(1)} % (len(units) + 1))::BIGINT AS b,
         CASE WHEN text = '' OR contains(text, {p}) OR contains(text, {s}) OR contains(text, {m}) OR {group(2)} % 100 >= {rate} THEN 'plain' WHEN {group(3)} % 100 < {spm_share} THEN 'spm' ELSE 'psm' END AS form FROM cut
), parts AS (
  SELECT doc_id, text, n, form,
         array_to_string(list_slice(units, 1, least(a, b)), '') AS prefix, array_to_string(list_slice(units, least(a, b) + 1, greatest(a, b)), '') AS middle, array_to_string(list_slice(units, greatest(a, b) + 1, n), '') AS suffix FROM drawn
), made AS (
  SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
         CASE form WHEN 'plain' THEN text WHEN 'psm' THEN {p} || prefix || {s} || suffix || {m} || middle ELSE {s} || suffix || {p} || prefix || {m} || middle END AS output FROM parts
), halves AS (
  SELECT *, CASE form WHEN 'psm' THEN string_split(output, {s}) WHEN 'spm' THEN string_split(output, {p}) END AS half FROM made
), thirds AS (
  SELECT *, string_split(half[2], {m}) AS tail FROM halves
), rebuilt AS (
  SELECT *, CASE form WHEN 'plain' THEN output WHEN 'psm' THEN substr(half[1], {ends[0]}) || tail[2] || tail[1] ELSE tail[1] || tail[2] || substr(half[1], {ends[1]}) END AS restored FROM thirds
)
SELECT doc_id, {', '.join(f'sha256({c[:-7]}) AS {c}' if c.endswith('_sha256') else c for c in columns)} FROM rebuilt"""


def _check(markers: tuple[str, str, str]) -> None:
    for a in markers:
        for b in markers:
            clash = a != b and (a in b) or any(b.startswith(a[k:]) for k in range(1, len(a)))
            if not a or clash or len(set(markers)) < 3:
                raise ValueError("markers must differ, and none may hold, or end as, the beginning of another")


def fill_middle(
    docs: DataFrame, columns: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output"), id_col: str = "doc_id", text_col: str = "text",
    seed: int = SEED, rate: int = RATE, spm_share: int = SPM_SHARE, markers: tuple[str, str, str] = MARKERS,
) -> DataFrame:
    """One row per input row: doc_id and ``columns``, any of n, form, prefix_chars, middle_chars, output, output_sha256, restored, restored_sha256.

    A text's lines, each with its line end, are cut at two places drawn from the id. ``rate`` of a hundred documents change form, ``spm_share`` of a hundred of these
    put the suffix first. A text that is empty, null (which counts as empty) or holds a marker stays plain, and its output is the text itself. restored is rebuilt from output and
    form alone. A null id is drawn as an empty one; repeated rows are rewritten alike; other columns aren't read, so their names can't clash; no rows give no rows.
    """
    _check(markers)
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    sql = fim_sql(list(columns), "batch", seed, rate, spm_share, markers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        con = duckdb.connect(config={"threads": 1})
        for batch in batches:
            for part in _rounds(batch):
                con.register("batch", pa.Table.from_batches([part]))
                yield from con.sql(sql).to_arrow_table().to_batches()
                con.unregister("batch")

    return docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{c} {COLUMNS[c]}" for c in columns))


def _rounds(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of about ROUND_BYTES of text."""
    import numpy as np

    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = upto[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(upto, before + ROUND_BYTES, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


#: The same result by splitting at line ends and adding up lengths, instead of matching and joining lines.
OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), u AS (
  SELECT *, CASE WHEN text = '' THEN 0 WHEN ends_with(text, chr(10)) THEN len(string_split(text, chr(10))) - 1 ELSE len(string_split(text, chr(10))) END AS n FROM d
), c AS (
  SELECT *, ('0x' || h[1:8])::UBIGINT % (n + 1) AS a, ('0x' || h[9:16])::UBIGINT % (n + 1) AS b, ('0x' || h[25:32])::UBIGINT % 100 < 50 AS spm,
         list_transform(string_split(text, chr(10)), lambda x: length(x) + 1) AS lens, text = '' OR regexp_matches(text, '<[PSM]>') AS plain FROM u
), e AS (
  SELECT *, coalesce(list_sum(lens[1:least(a, b)::BIGINT]), 0)::BIGINT AS x, least(length(text), coalesce(list_sum(lens[1:greatest(a, b)::BIGINT]), 0))::BIGINT AS y0 FROM c
), f AS (
  SELECT *, least(x, length(text)) AS p, y0 AS q FROM e
), g AS (
  SELECT *, CASE WHEN plain THEN text WHEN spm THEN '<S>' || substr(text, q + 1) || '<P>' || substr(text, 1, p) || '<M>' || substr(text, p + 1, q - p)
                 ELSE '<P>' || substr(text, 1, p) || '<S>' || substr(text, q + 1) || '<M>' || substr(text, p + 1, q - p) END AS output FROM f
)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form, CASE WHEN NOT plain THEN p END AS prefix_chars, CASE WHEN NOT plain THEN q - p END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256 FROM g
"""
