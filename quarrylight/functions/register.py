"""SQL names of the engine's functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quarrylight.sources.files import profile_json, profile_zip, read_csv, read_xlsx


def register(spark: SparkSession) -> None:
    """stable_id(prefix, value), collapse_space(text), strip_space(text), clean_text(text) as SQL functions;
    json_shape(binary), normalized_text(text), match_spans(text, pattern) by Arrow batches; and table functions over the bytes of a file:
    csv_cells(binary), xlsx_cells(binary), zip_members(binary), for LATERAL joins. Nulls give null, and no rows."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION stable_id(prefix STRING, value STRING) RETURNS STRING RETURN concat(prefix, '_', left(sha2(value, 256), 20))")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION collapse_space(t STRING) RETURNS STRING RETURN trim(regexp_replace(t, '(?U)\\s+', ' '))")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION strip_space(t STRING) RETURNS STRING RETURN regexp_replace(t, '(?U)\\s+', '')")
    spark.sql(r"""CREATE OR REPLACE TEMPORARY FUNCTION clean_text(t STRING) RETURNS STRING RETURN regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        replace(replace(t, '\u0000', ' '), '\u00ad', ''), '[ \\t]+', ' '), '\\n[ \\t]+', '\n'), '\\n{3,}', '\n\n'), '(?U)^\\s+|\\s+$', '')""")

    @F.pandas_udf("string")
    def json_shape(content: pd.Series) -> pd.Series:
        import json

        return content.map(lambda c: None if c is None else json.dumps(profile_json(bytes(c))["shape"]))

    @F.pandas_udf("string")
    def normalized_text(text: pd.Series) -> pd.Series:
        return text.str.normalize("NFKC").str.lower().str.replace(r"[^0-9a-z一-鿿]", "", regex=True)

    @F.pandas_udf("array<struct<text:string,start:int,end:int>>")
    def match_spans(text: pd.Series, pattern: pd.Series) -> pd.Series:
        import re

        def spans(t: str | None, p: str | None) -> list[dict] | None:
            return None if t is None or p is None else [{"text": m[0], "start": m.start(), "end": m.end()} for m in re.finditer(p, t, re.IGNORECASE)]

        return pd.Series([spans(t, p) for t, p in zip(text, pattern)], dtype=object)

    class CsvCells:
        def eval(self, content: bytes):
            for n, row in enumerate(read_csv(bytes(content))[0] if content is not None else ()):
                yield n, row

    class XlsxCells:
        def eval(self, content: bytes):
            for name, rows in read_xlsx(bytes(content)) if content is not None else ():
                for n, row in enumerate(rows):
                    yield name, n, row

    class ZipMembers:
        def eval(self, content: bytes):
            for m in profile_zip(bytes(content))["members"] if content is not None else ():
                yield m["path"], m["size_bytes"], m["compressed_size_bytes"], m["crc32"], m["is_directory"]

    spark.udtf.register("csv_cells", F.udtf(CsvCells, returnType="row_no bigint, cells array<string>"))
    spark.udtf.register("xlsx_cells", F.udtf(XlsxCells, returnType="sheet string, row_no bigint, cells array<string>"))
    spark.udtf.register("zip_members", F.udtf(ZipMembers, returnType="path string, size_bytes bigint, compressed_size_bytes bigint, crc32 string, is_directory boolean"))
    spark.udf.register("match_spans", match_spans)
    spark.udf.register("json_shape", json_shape)
    spark.udf.register("normalized_text", normalized_text)
