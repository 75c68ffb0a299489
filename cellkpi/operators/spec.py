"""Typed KPI specifications and their compilation to one groupBy/agg plan.

A spec is data: ordered output items plus grouping keys. Counter lists are
not enumerated; a ``CounterRule`` expands over the numeric (or text-typed
counter) columns of the input schema at compile time, with explicit
exceptions (other function, rename, second alias). This is how the large
vendor specs stay rules instead of long copied lists.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellkpi.functions.scalars import day_stamp
from cellkpi.operators.aggregate import deal_groups
from cellkpi.sources.labels import LabelCodes
from cellkpi.sources.vectors import BINS, bin_names

NUMERIC = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.DecimalType, T.BooleanType)
# Columns the pipeline adds itself; they are never counters.
PIPELINE_COLUMNS = ("pk_ft", "pk_date", "pk_market", "pk_hr", "pk_batch", "_source_file", "_rescued")
GRAINS = ("rop", "hour", "day")

@dataclass(frozen=True)
class Measure:
    """``func(source) AS alias``; null_policy 'zero' means ``func(IFNULL(source,0))``;
    ``bin``: of a packed histogram, this element (a missing one is NULL)."""
    func: str
    source: str
    alias: str | None = None
    null_policy: str = "keep"
    bin: int | None = None

    @property
    def name(self) -> str:
        return self.alias or self.source

    def column(self, dtypes: dict[str, str] | None = None) -> Column:
        # as text: one call a measure, where a wide spec has thousands
        src = f"`{self.source}`" if self.source != "*" else "1"
        if self.bin is not None:
            src = f"get({src}, {self.bin})"
        dt = (dtypes or {}).get(self.source.lower())
        if self.func in ("sum", "avg", "max") and dt == "string":
            src = f"try_cast({src} AS DOUBLE)"          # text counters: cast, never compare as text
        if dt == "boolean" and self.func != "count":
            src = f"CAST({src} AS INT)"
        if self.null_policy == "zero":
            src = f"coalesce({src}, 0)"
        if self.func not in ("sum", "max", "min", "avg", "count"):
            raise KeyError(self.func)
        return F.expr(f"{self.func}({src}) AS `{self.name}`")


@dataclass(frozen=True)
class Item:
    """Non-aggregated output.

    kind: 'key'   - SQL expression over group keys (``mo_dn2 as cell``)
          'const' - literal text (``'' as HL_Sectorlayer``)
          'time'  - time stamp that follows the grain (period start / hour / day)
          'run_id'- report run id ('unassigned' until stamped)
    """
    alias: str
    kind: str
    value: str | None = None


@dataclass(frozen=True)
class CounterRule:
    """Expand to one measure per counter column of the input.

    Counters = numeric or string columns that are not identity/key columns, and
    the bins of packed histograms, each under its own name.
    ``overrides``: source -> func; ``renames``: source -> alias;
    ``also``: source -> extra alias over the same aggregate; ``omit``: sources
    that are emitted elsewhere in the spec; ``only``: the counters that the
    spec names (None: every counter).
    """
    func: str = "sum"
    null_policy: str = "keep"
    overrides: tuple[tuple[str, str], ...] = ()
    renames: tuple[tuple[str, str], ...] = ()
    also: tuple[tuple[str, str], ...] = ()
    omit: tuple[str, ...] = ()
    override_null_policy: str | None = None
    only: tuple[str, ...] | None = None

    def expand(self, schema: T.StructType, exclude: Iterable[str]) -> list[Measure]:
        ex = {e.lower() for e in (*exclude, *PIPELINE_COLUMNS, *self.omit)}
        only = None if self.only is None else {o.lower() for o in self.only}
        ov = {k.lower(): v for k, v in self.overrides}
        rn = {k.lower(): v for k, v in self.renames}
        al = {}
        for k, v in self.also:
            al.setdefault(k.lower(), []).append(v)
        out: list[Measure] = []
        for f in schema.fields:
            bins = bin_names(f)
            if bins is None and not isinstance(f.dataType, (*NUMERIC, T.StringType)):
                continue
            for at, name in [(None, f.name)] if bins is None else enumerate(bins):
                lname = name.lower()
                if lname in ex or (only is not None and lname not in only):
                    continue
                func = ov.get(lname, self.func)
                pol = self.null_policy if lname not in ov else (self.override_null_policy or self.null_policy)
                if func == "avg":
                    pol = "keep"
                out.append(Measure(func, f.name, rn.get(lname, name), pol, at))
                for extra in al.get(lname, []):
                    out.append(Measure(func, f.name, extra, pol, at))
        return out


@dataclass(frozen=True)
class KpiSpec:
    name: str
    items: tuple = ()                         # ordered Measure | Item | CounterRule
    keys: tuple[str, ...] = ()                # non-time group keys
    time_keys: tuple[str, ...] = ()           # ROP-grain time keys
    hour_key: str = "hl_date"                 # hour-grain key / source of the day stamp
    identity: tuple[str, ...] = ()            # input columns that are never counters
    derived: bool = False                     # True when not stated by the source system
    meta: dict = field(default_factory=dict, compare=False, hash=False)

    def expanded(self, schema: T.StructType) -> list:
        """Output entries in order: Measure or Item (rules expanded)."""
        named = {i.source.lower() for i in self.items if isinstance(i, Measure)}
        excl = set(self.identity) | set(self.keys) | set(self.time_keys) | {self.hour_key} | named
        excl |= {i.value for i in self.items if isinstance(i, Item) and i.kind == "key" and i.value}
        out: list = []
        for it in self.items:
            if isinstance(it, CounterRule):
                out.extend(it.expand(schema, excl))
            else:
                out.append(it)
        return out

    def measures(self, schema: T.StructType) -> list[Measure]:
        return [e for e in self.expanded(schema) if isinstance(e, Measure)]

    def output_names(self, schema: T.StructType) -> list[str]:
        return [e.name if isinstance(e, Measure) else e.alias for e in self.expanded(schema)]


def hour_of(spec: KpiSpec) -> Column:
    """The hour a row belongs to (period starts that carry minutes are truncated)."""
    return F.date_trunc("hour", F.col(spec.hour_key))


def group_keys(spec: KpiSpec, grain: str) -> list[str]:
    if grain == "rop":
        return [*spec.time_keys, *spec.keys]
    if grain == "hour":
        return [spec.hour_key, *spec.keys]
    if grain == "day":
        return list(spec.keys)
    raise ValueError(f"grain must be one of {GRAINS}")


def _dedup_names(names: Sequence[str]) -> list[bool]:
    """Keep-mask dropping case-insensitive duplicate output names (last wins)."""
    seen, keep = set(), []
    for n in reversed(names):
        keep.append(n.lower() not in seen)
        seen.add(n.lower())
    return list(reversed(keep))


def _coded_aggregate(df: DataFrame, aggs: list[Column], measures: Sequence[Measure], labels: Sequence[int], codes: LabelCodes,
                     group: Callable[[DataFrame, list[Column]], DataFrame]) -> DataFrame:
    """``group`` with the text labels as codes: one scan, one hash aggregate."""
    aggs = list(aggs)
    for i in labels:
        df = codes.encode(df, measures[i].source, f"__label{i}")
        aggs[i] = F.min(f"__label{i}").alias(measures[i].name)
    g = group(df, aggs)
    for i in labels:
        g = codes.decode(g, measures[i].name)
    return g


def _packed_output(columns: list[tuple[Column, str, tuple | None]]) -> list[Column]:
    """Output columns; neighbouring bins of one histogram (same source, same name
    up to the number) become an array named without the number."""
    out: list[Column] = []
    i = 0
    while i < len(columns):
        col, name, vector = columns[i]
        j = i + 1
        while vector is not None and j < len(columns) and columns[j][2] == vector:
            j += 1
        if vector is None:
            out.append(col)
        else:
            out.append(F.array(*[c for c, _, _ in columns[i:j]]).alias(vector[1], metadata={BINS: [n for _, n, _ in columns[i:j]]}))
        i = j
    return out


def _runs(schema: T.StructType, keys: Sequence[str], measures: Sequence[Measure]) -> Callable[[DataFrame], DataFrame] | None:
    """The aggregate of rows in which those of a group are in one task, next to each other
    (``operators.runs``); None where these measures, or an installation without its packages, do not allow it."""
    try:
        from cellkpi.operators import runs
    except ImportError:
        return None
    wanted = [runs.Reduction(m.name, m.func, m.source, m.null_policy == "zero", m.bin) for m in measures]
    return (lambda rows: runs.aggregate_runs(rows, keys, wanted)) if runs.reducible(schema, keys, wanted) else None


def aggregate(df: DataFrame, spec: KpiSpec, *, grain: str = "rop",
              extra_keys: Sequence[str] = ("pk_ft", "pk_date", "pk_market", "pk_hr"),
              run_id: Column | None = None, labels: DataFrame | LabelCodes | None = None, packed: bool = False,
              widen: Callable[[DataFrame], DataFrame] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Compile ``spec`` at ``grain`` into a single groupBy().agg() over ``df``.

    ``extra_keys`` are the store partition keys; adding them makes one query
    over all selected partitions equal to the per-partition queries of a
    loop (pk_hr need not follow hl_date). At 'day' grain pk_hr is dropped.
    ``labels``: texts of the label columns (``sources.labels``), with which
    labels are aggregated as codes; without them, or where they are too many to
    broadcast, MIN over text makes Spark aggregate by sorting. ``packed``: histograms
    that come as arrays stay arrays in the result. ``widen`` adds the wide counters to the
    rows; it is called after they are dealt to tasks ``by`` some of the keys (``deal_groups``)
    and put in the order of all, so that runs of rows are added up (``operators.runs``).
    """
    if grain == "hour" and dict(df.dtypes).get(next((c for c in df.columns if c.lower() == spec.hour_key.lower()), "")) != "string":
        df = df.withColumn(next(c for c in df.columns if c.lower() == spec.hour_key.lower()), hour_of(spec))
    extra = [k for k in extra_keys if k in df.columns and not (grain == "day" and k == "pk_hr")]
    keys = [k for k in group_keys(spec, grain) if k.lower() not in {e.lower() for e in extra}] + extra
    wide = df if widen is None else widen(df)
    dtypes = {n.lower(): t for n, t in wide.dtypes}
    entries = spec_entries(spec, wide.schema)
    measures = [e for e in entries if isinstance(e, Measure)]
    aggs = [m.column(dtypes) for m in measures]
    time_items = [i for i in spec.items if isinstance(i, Item) and i.kind == "time"]
    if grain == "day" and time_items:
        aggs.append(F.min(day_stamp(spec.hour_key)).alias("_day_stamp"))
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_rows")]
    texts = [i for i, m in enumerate(measures) if m.func == "min" and dtypes.get(m.source.lower()) == "string"]
    by_runs = _runs(wide.schema, keys, measures) if widen is not None and len(aggs) == len(measures) else None
    if by_runs is not None:              # labels get codes in each batch
        return report_columns(by_runs(widen(deal_groups(df, by, order=keys))), spec, entries, extra, grain, run_id, packed)

    def group(rows: DataFrame, aggs: list[Column]) -> DataFrame:
        return (rows if widen is None else widen(deal_groups(rows, by))).groupBy(*keys).agg(*aggs)

    codes = LabelCodes(labels) if texts and isinstance(labels, DataFrame) else labels
    if texts and codes is not None and codes.usable:
        g = _coded_aggregate(df, aggs, measures, texts, codes, group)
    else:
        g = group(df, aggs)

    return report_columns(g, spec, entries, extra, grain, run_id, packed)


def spec_entries(spec: KpiSpec, schema: T.StructType) -> list:
    """Outputs of ``spec`` over ``schema``; of case-variant duplicates the last stays."""
    entries = spec.expanded(schema)
    mask = _dedup_names([e.name if isinstance(e, Measure) else e.alias for e in entries])
    return [e for e, k in zip(entries, mask) if k]


def report_columns(g: DataFrame, spec: KpiSpec, entries: Sequence, extra: Sequence[str], grain: str,
                   run_id: Column | None = None, packed: bool = False) -> DataFrame:
    """Outputs of a spec from its groups: key columns, and measures under their names."""
    out: list[Column] = []
    names: list[str] = []
    vectors: dict[int, tuple] = {}
    for it in entries:
        if isinstance(it, Measure):
            if packed and it.bin is not None and (m := re.fullmatch(r"(.+)_\d+", it.name)):
                vectors[len(out)] = (it.source, m[1])
            out.append(F.col(f"`{it.name}`")); names.append(it.name)
        elif it.kind == "key":
            out.append(F.expr(it.value or it.alias).alias(it.alias)); names.append(it.alias)
        elif it.kind == "const":
            out.append(F.lit(it.value).alias(it.alias)); names.append(it.alias)
        elif it.kind == "run_id":
            out.append((run_id if run_id is not None else F.lit(it.value or "unassigned")).alias(it.alias))
            names.append(it.alias)
        elif it.kind == "time":
            if grain == "rop":
                src = F.col(it.value)
            elif grain == "hour":
                src = F.col(spec.hour_key)
            else:
                src = F.col("_day_stamp")
            out.append(src.alias(it.alias)); names.append(it.alias)
    out += [F.col(k) for k in extra if k.lower() not in {n.lower() for n in names}]
    names += [""] * (len(out) - len(names))
    return g.select(*_packed_output([(c, n, vectors.get(i)) for i, (c, n) in enumerate(zip(out, names, strict=True))]))


def aggregate_from_schema(df: DataFrame, schema: T.StructType,
                          extra_keys: Sequence[str] = ()) -> DataFrame:
    """Schema-driven builder: field metadata 'agg' = MIN/MAX/SUM -> aggregate,
    EXCLUDE/absent -> dropped, a text that calls an aggregate (``sum(a)/sum(b)``)
    -> a formula, any other text -> SQL expression used as a group key (e.g.
    the cell name)."""
    aggs, keys = [], []
    dtypes = {n.lower(): t for n, t in df.dtypes}
    for f in schema.fields:
        a = (f.metadata or {}).get("agg")
        if a is None or a.upper() == "EXCLUDE":
            continue
        if a.upper() in ("MIN", "MAX", "SUM"):
            aggs.append(Measure(a.lower(), f.name).column(dtypes))
        elif AGGREGATE_CALL.search(a):
            aggs.append(F.expr(a).alias(f.name))
        else:
            keys.append(F.expr(a).alias(f.name))
    keys += [F.col(k) for k in extra_keys]
    return df.groupBy(*keys).agg(*aggs)


# An 'agg' text that calls one of these is a formula over the group, any other text is a group key.
AGGREGATE_CALL = re.compile(r"\b(sum|min|max|avg|count)\s*\(", re.I)


# --------------------------------------------------------------------------
# Specs kept as SQL text (the source system's feature files)
# --------------------------------------------------------------------------

def load_sql_features(path: str, *, pick: str = "first") -> dict[str, tuple[str, str]]:
    """Read a feature file ``{"features":[{"name","sql":[{"SELECT","GROUPBY"}]}]}``.

    ``pick='first'`` takes the first sql entry of a feature (Ericsson jobs);
    ``pick='last'`` the last entry that has both parts (Nokia jobs).
    """
    with open(path) as fh:
        return parse_sql_features(fh.read(), pick=pick)


def parse_sql_features(text: str, *, pick: str = "first") -> dict[str, tuple[str, str]]:
    """The features of a feature file's text (see :func:`load_sql_features`)."""
    import json

    doc = json.loads(text)
    out = {}
    for feat in doc.get("features", []):
        entries = [e for e in feat.get("sql", []) if e.get("SELECT") and e.get("GROUPBY")]
        if entries:
            e = entries[0] if pick == "first" else entries[-1]
            out[feat["name"]] = (e["SELECT"].strip().rstrip(","), e["GROUPBY"].strip().rstrip(","))
    return out


# One item of a SELECT text that aggregates a counter: func([IFNULL(]counter[, 0)]) [AS alias].
_MEASURE_ITEM = re.compile(r"\b(sum|min|max|avg)\s*\(\s*(?:(ifnull)\s*\(\s*)?([A-Za-z_]\w*)\s*(?:,\s*0\s*\)\s*)?\)"
                           r"(?:\s+as\s+([A-Za-z_]\w*))?", re.I)


def typed_measures(select: str) -> list[Measure]:
    """The counter aggregates that a SELECT text names, as typed measures, in
    order: the counters of a spec come from its file, not from the data."""
    return [Measure(m[1].lower(), m[3], m[4], "zero" if m[2] else "keep") for m in _MEASURE_ITEM.finditer(select)]


def with_measures(spec: KpiSpec, measures: Sequence[Measure]) -> KpiSpec:
    """``spec`` with its counter rule replaced by named measures (those it already
    has stay where they are)."""
    own = {i.name.lower() for i in spec.items if isinstance(i, Measure)}
    named = [m for m in measures if m.name.lower() not in own]
    items = [x for i in spec.items for x in (named if isinstance(i, CounterRule) else [i])]
    return replace(spec, items=tuple(items))


def typed_store(store: DataFrame, select: str) -> DataFrame:
    """Text columns that ``select`` sums, averages or compares by size become
    numbers (tolerantly: junk is NULL), so '10' > '9'; a column that is only a
    label (MIN of text) stays text."""
    text = {n.lower(): n for n, t in store.dtypes if t == "string"}
    numeric = {m.source.lower() for m in typed_measures(select) if m.func != "min"}
    return store.withColumns({text[c]: F.col(f"`{text[c]}`").try_cast("double") for c in sorted(numeric & text.keys())})


def _named_items(select: str) -> str:
    """Aggregates without an alias get their counter's name."""
    def name(m: re.Match) -> str:
        return m[0] if m[4] else f"{m[0]} AS {m[3]}"
    return _MEASURE_ITEM.sub(name, select) if not _NESTED.search(select) else select


_NESTED = re.compile(r"\)\s*[-+*/]|[-+*/]\s*(?:sum|min|max|avg)\s*\(", re.I)      # formulas keep their own text


def sql_feature_aggregate(store: DataFrame, select: str, groupby: str, *,
                          extra_keys: Sequence[str] = ("pk_ft", "pk_date", "pk_market", "pk_hr"),
                          run_id: Column | None = None, dealt: bool = False) -> DataFrame:
    """Run a text spec over ``store`` with Spark SQL, set-at-a-time.

    Counters kept as text are typed first (:func:`typed_store`).

    The partition keys are appended to the select list and GROUP BY so one
    query over all selected partitions equals a loop of per-partition
    queries; the 'unassigned' run id is replaced by ``run_id`` (a column,
    not text substitution); of case-variant duplicate output names the last
    is kept (parquet rejects duplicates). ``dealt``: the rows of a group are in one task,
    next to each other, and may be aggregated as runs.
    """
    store, select = typed_store(store, select), _named_items(select)
    extra = [k for k in extra_keys if k in store.columns]
    sel = select + "".join(f", {k}" for k in extra)
    grp = groupby + "".join(f", {k}" for k in extra)
    keys = [k.strip() for k in grp.split(",")]
    df = _text_by_runs(store, sel, keys) if dealt else None
    if df is None:
        df = store.sparkSession.sql(f"SELECT {sel} FROM {{kpi}} GROUP BY {grp}", kpi=store)
    names = df.columns
    keep = _dedup_names(names)
    df = df.toDF(*[f"_c{i}" for i in range(len(names))]).select(
        *[F.col(f"_c{i}").alias(n) for i, (n, k) in enumerate(zip(names, keep)) if k])
    if run_id is not None and "MGR_RUN_ID" in df.columns:
        df = df.withColumn("MGR_RUN_ID", run_id)
    return df


def _text_by_runs(store: DataFrame, select: str, keys: Sequence[str]) -> DataFrame | None:
    """A text spec over dealt rows: its counter aggregates by runs, the rest of its
    text over their results. None where it holds any other aggregate."""
    found: list[Measure] = []

    def named(m: re.Match) -> str:
        found.append(Measure(m[1].lower(), m[3], f"__m{len(found)}", "zero" if m[2] else "keep"))
        return found[-1].name + (f" AS {m[4]}" if m[4] else "")

    rest = _MEASURE_ITEM.sub(named, select)
    if not found or "(" in rest or not all(re.fullmatch(r"[A-Za-z_]\w*", k) for k in keys):
        return None
    by_runs = _runs(store.schema, keys, found)
    return None if by_runs is None else store.sparkSession.sql(f"SELECT {rest} FROM {{kpi}}", kpi=by_runs(store))
