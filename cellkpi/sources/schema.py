"""Schema registry: counter-family schemas stored as JSON field lists."""

from __future__ import annotations

import json
import os
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Identity (non-counter) columns per vendor/technology layout.
IDENTITY = {
    ("ericsson", "lte"): ("MGR_RUN_ID", "MGR_RUNID", "HL_DATE", "HL_MARKET", "Region", "Market", "SubNetwork_2",
                          "MeContext", "EUtranCellFDD", "PERIOD_START_TIME", "OSSName", "Cntr"),
    ("ericsson", "umts"): ("MGR_RUN_ID", "MGR_RUNID", "HL_DATE", "HL_MARKET", "Region", "Market", "SubNetwork_2",
                           "MeContext", "UtranCell", "PERIOD_START_TIME", "OSSName", "Cntr"),
    ("nokia", "lte"): ("MGR_RUN_ID", "Region", "Market", "OSS", "PERIOD_START_TIME", "MO_DN", "MO_DN2",
                       "MO_DN_Source"),
    ("nokia", "umts"): ("MGR_RUN_ID", "Region", "Market", "OSS", "BASEID", "LOCALMOID", "CELL_ID_1",
                        "CELL_ID_2", "PERIOD_START_TIME"),
}


def schema_from_fields(fields: list[dict]) -> T.StructType:
    """JSON field list -> StructType. A non-standard ``agg`` property moves into metadata."""
    out = []
    for f in fields:
        f = dict(f)
        agg = f.pop("agg", None)
        md = dict(f.get("metadata") or {})
        if agg is not None:
            md["agg"] = agg
        f["metadata"] = md
        f.setdefault("nullable", True)
        out.append(T.StructField.fromJson(f))
    return T.StructType(out)


def load_schema(path: str) -> T.StructType:
    with open(path) as fh:
        return schema_from_fields(json.load(fh))


def spec_family_name(store_type: str, vendor: str = "nokia") -> str:
    """Store type 'lte_cell_avail' <-> spec/schema name 'lte_nokia_cell_avail'."""
    tech, _, rest = store_type.partition("_")
    return f"{tech}_{vendor}_{rest}"


def schema_file_name(store_type: str, vendor: str = "nokia") -> str:
    return f"{spec_family_name(store_type, vendor)}_schema.json"


class SchemaRegistry:
    """Schemas of the known counter families, keyed by store type."""

    def __init__(self, schemas: dict[str, T.StructType]):
        self.schemas = dict(schemas)

    @classmethod
    def from_dir(cls, path: str, vendor: str = "nokia") -> "SchemaRegistry":
        out = {}
        marker = f"_{vendor}_"
        for fn in sorted(os.listdir(path)):
            if fn.endswith("_schema.json") and marker in fn:
                tech, _, rest = fn[: -len("_schema.json")].partition(marker)
                out[f"{tech}_{rest}"] = load_schema(os.path.join(path, fn))
        return cls(out)

    @classmethod
    def from_path(cls, spark, path: str, vendor: str = "nokia") -> "SchemaRegistry":
        """Schema files of a folder in any store that Spark reads."""
        files = spark.read.text(f"{path.rstrip('/')}/*_schema.json", wholetext=True).select("value", F.col("_metadata.file_name").alias("name"))
        out, marker = {}, f"_{vendor}_"
        for r in files.orderBy("name").collect():                  # a row a family
            if marker in r.name:
                tech, _, rest = r.name[: -len("_schema.json")].partition(marker)
                out[f"{tech}_{rest}"] = schema_from_fields(json.loads(r.value))
        return cls(out)

    def types(self) -> list[str]:
        return sorted(self.schemas)

    def __contains__(self, t: str) -> bool:
        return t in self.schemas

    def __getitem__(self, t: str) -> T.StructType:
        return self.schemas[t]

    def as_frame(self, spark) -> DataFrame:
        """Known family types as a one-column DataFrame (for anti joins)."""
        return spark.createDataFrame([(t,) for t in self.types()], "pk_ft string")


def all_string(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


def typed_from_strings(df: DataFrame, schema: T.StructType | None = None, *,
                       identity: Iterable[str] = ()) -> DataFrame:
    """Tolerant typing of text columns (header-only reads, text counters).

    With ``schema``: each column is cast to its registered type with
    ``try_cast`` (bad text -> NULL). Without: every non-identity string
    column is treated as a numeric counter and cast to double.
    """
    ident = {c.lower() for c in identity}
    if schema is not None:
        types = {f.name.lower(): f.dataType for f in schema.fields}
        return df.select(*[
            (F.col(f"`{c}`").try_cast(types[c.lower()]) if c.lower() in types and t == "string"
             and not isinstance(types[c.lower()], T.StringType) else F.col(f"`{c}`")).alias(c)
            for c, t in df.dtypes])
    return df.select(*[
        (F.col(f"`{c}`").try_cast("double") if t == "string" and c.lower() not in ident else F.col(f"`{c}`")).alias(c)
        for c, t in df.dtypes])


def text_counters_to_double(df: DataFrame, identity: Iterable[str]) -> DataFrame:
    """Registered string-typed counters -> double (so MAX never compares text)."""
    return typed_from_strings(df, None, identity=identity)

