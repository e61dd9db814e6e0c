"""Mart jobs: DataFrames in, DataFrames out.

Landed files are read and marts written only in the ``run_…`` functions. The others may store small sides and rows that
they read twice in the shared work folder (``session.stored``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowmart import functions as fx, schema, sinks, sources
from flowmart.operators import conform, enrich, quality, reshape
from flowmart.operators.conform import StageTable
from flowmart.session import stored

# ---- wide indicator files → staged rows ----------------------------------------------------


def stage_by_class(wide: DataFrame, drop_nulls: bool = False) -> DataFrame:
    """A class file. Where its headers are not the known ones, its four leading columns count by position: office, its
    code, origin, class."""
    leading = [c for c in wide.columns if c not in reshape.year_columns(wide.columns)]
    if all(c.strip() in schema.HEADER_NAMES for c in leading):
        return stage_indicator(wide, drop_nulls)
    if len(leading) != 4 or wide.columns[:4] != leading:
        raise ValueError(f"a class file needs four columns ahead of the years, not {leading}")
    return stage_indicator(conform.apply_layout(wide, "by_class"), drop_nulls)


def stage_indicator(wide: DataFrame, drop_nulls: bool = False) -> DataFrame:
    """One wide indicator file (bilateral or by class) to long rows with canonical names and types.

    A leading column that is none of the known ones fails: without it rows could not be told apart.
    """
    named = wide.toDF(*[c.strip() for c in wide.columns]).withColumnsRenamed(schema.HEADER_NAMES)
    years = reshape.year_columns(named.columns)
    known = [c for c in [*schema.HEADER_NAMES.values(), "class_code"] if c in named.columns]
    unknown = [c for c in named.columns if c not in known and c not in years]
    if unknown:
        raise ValueError(f"unknown columns in an indicator file: {unknown}")
    long = reshape.unpivot_years(named.select(*known, *[F.col(f"`{c}`") for c in years]), known, drop_nulls=drop_nulls)
    texts = {c: fx.blank_to_null(c) for c in known}
    return long.withColumns({**texts, "count": fx.to_number("count")}).select("year", *known, "count")


def stage_unilateral(wide: DataFrame, typed: bool, base_year: int | None = None, drop_nulls: bool = False) -> DataFrame:
    """An in-force file (office totals only): the origin is World; the patent file has one more leading column."""
    laid = conform.apply_layout(wide, "unilateral_typed" if typed else "unilateral", base_year)
    return stage_indicator(laid, drop_nulls)


# ---- flows ---------------------------------------------------------------------------------


def flows_mart(
    staged: Mapping[str, DataFrame],
    office_codes: DataFrame,
    supplement: DataFrame | None = None,
    indicators: Sequence[str] = schema.FLOW_INDICATORS,
    code_order: str | None = None,
) -> DataFrame:
    """Staged indicators to the flows fact: supplement, World naming, office codes, union, contract.

    ``office_codes`` has ``entity_name, st3_code``; ``supplement`` has ``year, region, direct_apps, madrid_apps``.
    """
    frames = {code: df for code, df in staged.items() if code in indicators}
    counted = {code: column for code, column in schema.SUPPLEMENT_COUNTS.items() if code in frames and supplement is not None}
    fact = enrich.union_indicators(_mark_codes({c: df for c, df in frames.items() if c not in counted})) if len(frames) > len(counted) else None
    if counted:
        # One join for all supplemented indicators together.
        each = F.explode(F.array(*[F.struct(F.lit(c).alias("indicator"), F.col(x).alias("extra")) for c, x in counted.items()]))
        extra = supplement.withColumnRenamed("region", "origin").distinct().select("year", "origin", each.alias("e")).select(
            "year", "origin", "e.*", F.lit(schema.SUPPLEMENT_OFFICE).alias("destination_office"),
            F.lit(schema.SUPPLEMENT_OFFICE_CODE).alias("destination_office_st3_code"),
        )
        keys = ["year", "origin", "destination_office", "destination_office_st3_code", "indicator"]
        base = enrich.union_indicators({c: frames[c] for c in counted}).select(*keys, "count")
        more = enrich.add_counts(base, extra, keys, "count", "extra")
        more = more.withColumns({"_own_origin": F.lit(False), "_own_destination_office": F.lit(True)})
        fact = more if fact is None else fact.unionByName(more, allowMissingColumns=True)
    fact = _with_office_codes(fact, office_codes, code_order, {schema.TOTAL: schema.WORLD})
    return conform.to_contract(fact, schema.FLOWS)


NAMES = ("origin", "destination_office")


def _mark_codes(frames: Mapping[str, DataFrame], names: Sequence[str] = NAMES) -> dict[str, DataFrame]:
    """Note per frame whether it brings office codes of its own; only where it does not are they looked up."""
    return {
        key: df.withColumns({f"_own_{n}": F.lit(f"{n}_st3_code" in df.columns) for n in names}) for key, df in frames.items()
    }


def _with_office_codes(
    df: DataFrame, office_codes: DataFrame, order: str | None, members: Mapping[str, str], names: Sequence[str] = NAMES,
    ignore_case: bool = False,
) -> DataFrame:
    """Member names, then office codes, over the union: one join per name column for all indicators together."""
    df = conform.harmonize(df, list(NAMES), members, ignore_case)
    side = enrich.lookup_side(office_codes, "entity_name", "st3_code", order)
    for n in names:
        code = f"{n}_st3_code"
        df = enrich.lookup(df, side, n, "st3_code", f"_code_{n}", unique=True)
        own = F.col(code) if code in df.columns else F.lit(None).cast("string")
        df = df.withColumn(code, fx.blank_to_null(F.when(F.col(f"_own_{n}"), own).otherwise(F.col(f"_code_{n}"))))
        df = conform.fill_code(df, n, code).drop(f"_own_{n}", f"_code_{n}")
    return df


# ---- flows by class ------------------------------------------------------------------------


def class_mart(
    staged: Mapping[str, DataFrame],
    office_codes: DataFrame,
    labels: DataFrame,
    indicators: Sequence[str] = schema.CLASS_INDICATORS,
    pad: bool = False,
    match: str = "prefix",
    fallback: str = "raw",
    drop_nulls: bool = False,
    label_order: str | None = None,
    code_order: str | None = None,
) -> DataFrame:
    """Staged class indicators to the class fact; labels come from ``enrich.class_label_dim``.

    The class type follows from the name of the class column or, when it is plain ``class_code``, from the indicator.
    """
    frames = {}
    for code, df in staged.items():
        if code not in indicators:
            continue
        class_col = next((c for c in [*schema.CLASS_TYPES, "class_code"] if c in df.columns), None)
        if class_col is None:
            raise ValueError(f"{code}: no classification column among {df.columns}")
        class_type = schema.CLASS_TYPES.get(class_col) or schema.CLASS_TYPE_OF_CATEGORY[code[:2]]
        wanted = ["year", "origin", "destination_office", "destination_office_st3_code", class_col, "count"]
        df = sources.project_existing(df, wanted).withColumnRenamed(class_col, "class_code")
        frames[code] = conform.with_constants(df, class_type=class_type)
    if not frames:
        raise ValueError("no class indicators staged")
    names = ("destination_office",)
    fact = enrich.union_indicators(_mark_codes(frames, names), "ip_indicator")
    fact = _with_office_codes(fact, office_codes, code_order, {schema.TOTAL: schema.WORLD}, names, ignore_case=True)
    fact = conform.to_contract(fact, schema.CLASS_FLOWS)
    fact = enrich.label_classes(fact, labels, pad=pad, match=match, fallback=fallback, order=label_order)
    return conform.drop_null(fact, ["year", "count"]) if drop_nulls else fact


# ---- flows by residency --------------------------------------------------------------------


def residency_mart(
    files: Mapping[str, DataFrame], base_year: int | None = None, total: str = schema.TOTAL, trim: bool = False
) -> DataFrame:
    """Residency files, keyed ``<indicator>_office`` or ``<indicator>_origin``, to one fact."""
    frames = []
    for key, wide in files.items():
        indicator, _, side = key.partition("_")
        if side not in ("office", "origin"):
            continue
        laid = conform.apply_layout(wide, f"by_{side}", base_year)
        if trim:
            laid = conform.trim_trailing_years(laid, [c for c in laid.columns if c.isdigit()])
        frames.append(conform.with_constants(reshape.residency_long(laid, side, total), indicator=indicator))
    return conform.to_contract(enrich.union_flows(frames, distinct=False), schema.RESIDENCY_FLOWS)


# ---- macro flows ---------------------------------------------------------------------------

# Fixed columns and categories of the four macro tables.
MACRO_TABLES = {
    "imports": StageTable(
        "Estimates", ("Value of imports",), {"REF_DATE": "year", "Country": "region", "VALUE": "dollar_value"}
    ),
    "exports": StageTable(
        "Estimates", ("Value of exports",),
        {"REF_DATE": "year", "Country of destination": "region", "VALUE": "dollar_value"},
    ),
    "fdi_immediate": StageTable(
        "Canadian and foreign direct investment",
        (
            "Canadian direct investment abroad - total book value",
            "Foreign direct investment in Canada - total book value",
        ),
        {
            "REF_DATE": "year", "Canadian and foreign direct investment": "fdi_type", "Countries or regions": "region",
            "VALUE": "dollar_value",
        },
    ),
    "fdi_ultimate": StageTable(
        "Type of direct investment",
        (
            "Canadian direct investment abroad by ultimate investor country – total book value",
            "Foreign direct investment in Canada by ultimate investor country - total book value",
        ),
        {
            "REF_DATE": "year", "Type of direct investment": "fdi_type", "Countries or regions": "region",
            "VALUE": "dollar_value",
        },
    ),
}
MACRO_FLOW_NAMES = {"imports": schema.IMPORTS_FLOW, "exports": schema.EXPORTS_FLOW}


def macro_flows_mart(tables: Mapping[str, DataFrame], configs: Mapping[str, StageTable] = MACRO_TABLES) -> DataFrame:
    """Imports, exports and investment tables to one fact of year, region, flow type and value."""
    frames = []
    for name, raw in tables.items():
        staged = conform.stage_table(raw, configs[name])
        if name in MACRO_FLOW_NAMES:
            flow = conform.with_constants(staged, flow_type=MACRO_FLOW_NAMES[name])
        else:
            flow = conform.relabel(staged, "fdi_type", schema.INVESTMENT_FLOWS, "flow_type")
        frames.append(flow.select(*schema.MACRO_FLOWS.names))
    return enrich.union_flows(frames)


# ---- trade by industry ---------------------------------------------------------------------


@dataclass(frozen=True)
class TradeColumns:
    """Columns of the raw trade table."""

    date: str = "REF_DATE"
    trade: str = "Trade"
    partner: str = "Trading Partners"
    industry: str = schema.INDUSTRY_COLUMN
    value: str = "VALUE"


def stage_industry_trade(
    raw: DataFrame, columns: TradeColumns = TradeColumns(), trade_types: Sequence[str] = schema.TRADE_TYPES
) -> DataFrame:
    """Imports and exports of the total and of four-digit industry groups."""
    c = columns
    kept = raw.where(F.col(c.trade).isin(*trade_types) & fx.is_industry_group(F.col(f"`{c.industry}`")))
    return kept.select(
        fx.year_of(c.date).alias("year"),
        F.col(c.trade).alias("trade_type"),
        F.col(c.partner).alias("trading_partner"),
        F.col(f"`{c.industry}`").alias("naics"),
        F.col(c.value).cast("double").alias("cad_value"),
    )


def industry_trade_mart(staged: DataFrame) -> DataFrame:
    """Yearly trade per partner and industry.

    Rows are summed by their text first, so the text is parsed once per group instead of once per row.
    """
    keys = [n for n in schema.INDUSTRY_TRADE.names if n != "cad_value"]
    by_text = staged.groupBy("year", "trade_type", "trading_partner", "naics").agg(F.sum("cad_value").alias("cad_value"))
    sums = conform.parse_industry(by_text, "naics").groupBy(*keys).agg(F.sum("cad_value").alias("cad_value"))
    return sums.select(*schema.INDUSTRY_TRADE.names)


INDUSTRY_ORDER = ["year", "trading_partner", "trade_type", "naics_name"]

# ---- charges -------------------------------------------------------------------------------

# Fixed dimensions of the charges documents.
CHARGES_DIMS = [
    "REF_AREA", "COUNTERPART_AREA", "MEASURE", "ACCOUNTING_ENTRY", "FS_ENTRY", "FREQ", "UNIT_MEASURE", "ADJUSTMENT",
    "TIME_PERIOD",
]


def stage_charges(documents: DataFrame, dims: Sequence[str] = CHARGES_DIMS) -> DataFrame:
    """Decoded observations of SDMX-JSON documents."""
    return sources.decode_sdmx(documents, dims, "COUNTERPART_AREA", value_out="value_cad_millions")


def clean_charges(decoded: DataFrame) -> DataFrame:
    """Actual observations of the charges measure. Documents without a status attribute are kept whole."""
    if "status_reported" in decoded.columns:
        shown = F.when(F.col("status_reported"), F.col("obs_status")).otherwise(schema.ACTUAL_STATUS)
        decoded = decoded.withColumn("obs_status", shown)
    kept = conform.observation_gate(decoded, value_col="value_cad_millions")
    return kept.select(
        fx.to_whole("TIME_PERIOD").alias("year"),
        F.col("COUNTERPART_AREA").alias("counterpart_area"),
        "counterpart_country",
        "value_cad_millions",
    )


def ip_charges_mart(cleaned: DataFrame) -> DataFrame:
    """The charges fact with harmonized country names."""
    named = conform.rename_by_code(cleaned, "counterpart_area", "counterpart_country", schema.CHARGES_NAMES)
    return conform.with_constants(named, flow_type=schema.CHARGES_FLOW).select(*schema.CHARGES.names)


def charges_rules(expected_rows: int | None = None) -> list:
    """The contract that a charges mart must pass before it is loaded."""
    rules = [
        quality.columns_are(schema.CHARGES.names),
        quality.no_nulls(schema.CHARGES.names),
        quality.no_blanks(["counterpart_country", "flow_type"]),
        quality.type_is("year", "integer"),
        quality.in_range("year", *schema.CHARGES_YEARS),
        quality.only_value("flow_type", schema.CHARGES_FLOW),
        quality.type_is("value_cad_millions", "numeric"),
        quality.some("negative", F.col("value_cad_millions") < 0),
        quality.some("nonzero", F.col("value_cad_millions") != 0),
        quality.without_members("counterpart_country", schema.CHARGES_BANNED),
        quality.with_members("counterpart_country", schema.CHARGES_REQUIRED),
        quality.UniqueKey(("year", "counterpart_country")),
        quality.spot(
            "united_states_2022",
            (F.col("counterpart_country") == "United States") & (F.col("year") == 2022),
            F.col("value_cad_millions") < 0,
        ),
    ]
    return rules if expected_rows is None else [*rules, quality.row_count_is(expected_rows)]


def charges_load(mart: DataFrame, regions: DataFrame, check: bool = True) -> DataFrame:
    """Rows to load: region ids instead of names. Unmatched names abort with their list when ``check`` is on."""
    named = conform.harmonize(
        mart.withColumn("region", F.col("counterpart_country")), ["region"], {schema.WORLD: schema.ALL_COUNTRIES}
    )
    dim = regions.select("region", "macroecon_region_id")
    if check:
        enrich.require_matched(named, dim, "region")
    return enrich.guarded_join(named, dim, "region").select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.CHARGES_LOAD.fields]
    )


# ---- macro stats, office pairs, regions ----------------------------------------------------


# Fixed headers of the statistics file; two of them differ only in case, so they are renamed by place.
STATS_HEADERS = {"series": "wb_series_id", "Series": "series", "Country": "region", "economy": "wb_region_code"}


def macro_stats(wide: DataFrame) -> DataFrame:
    """Statistics with one ``YR####`` column per year to long rows."""
    named = wide.toDF(*[STATS_HEADERS.get(c, c) for c in wide.columns])
    ids = ["wb_region_code", "region", "series"]
    years = reshape.year_columns(named.columns, prefix="YR")
    long = reshape.unpivot_years(named.select(*ids, *years), ids, prefix="YR", value="value")
    return conform.to_contract(long, schema.MACRO_STATS)


def office_pairs_mart(
    wide: DataFrame,
    ids: Sequence[str] = ("Office Of Earlier Examination", "Office of Later Examination", "Year"),
    routes: Sequence[str] = ("National", "PCT"),
) -> DataFrame:
    """Two counts per office pair and year to one row per filing route."""
    named = conform.normalize_headers(wide, lower=False)
    counts = named.select(*[F.col(f"`{c}`") for c in ids], *[fx.null_to_zero_int(c).alias(c) for c in routes])
    long = reshape.unpivot_rest(counts, ids, "Filing Route", "Count")
    renamed = long.withColumnsRenamed(dict(zip(ids, ("Earlier Office", "Later Office", "year"))))
    return conform.to_contract(renamed, schema.OFFICE_PAIRS)


# Fixed headers of the country classification files.
SOCIAL_HEADERS = {
    "Level": "hierarchical_level", "Hierarchical structure": "hierarchical_desc", "Code": "sccai_code",
    "Parent Code": "parent_sccai_code", "Class title": "region", "Footnotes": "sccai_social_notes",
}
COUNTRY_HEADERS = {
    "Code": "sccai_code", "Countries and Areas of Interest": "regions", "Num-3": "m49_code",
    "Alpha-2": "iso_alpha_2_code", "Alpha-3": "iso_alpha_3_code", "Footnotes": "sccai_notes",
}


def country_regions(social: DataFrame, countries: DataFrame) -> DataFrame:
    """The country hierarchy with its code systems, one merged note column and a surrogate key."""
    def cleaned(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
        df = df.withColumnsRenamed(dict(names))
        return df.select(*[fx.blank_to_null(F.col(f"`{c}`").cast("string")).alias(c) for c in df.columns])

    codes = cleaned(countries, COUNTRY_HEADERS).drop("regions")
    joined = enrich.attach(cleaned(social, SOCIAL_HEADERS), codes, "sccai_code")
    merged = enrich.merge_columns(joined, "sccai_social_notes", "sccai_notes", "notes")
    return conform.with_surrogate_key(merged, "sccai_code_id", ["hierarchical_level", "sccai_code", "region"])


def economy_regions(economies: DataFrame, regions: DataFrame) -> dict[str, DataFrame]:
    """Economies by region and by administrative region, and all economies with the latter's name."""
    named = economies.withColumnsRenamed(
        {"id": "wb_economy_code", "name": "wb_economy_name", "region": "region_code", "adminregion": "admin_region_code"}
    )
    texts = [f.name for f in named.schema.fields if f.dataType.simpleString() == "string"]
    named = named.withColumns({c: fx.blank_to_null(c) for c in texts})
    regions = regions.withColumnsRenamed({"code": "region_code", "name": "region_name"})
    admin = enrich.region_map(named, regions, "admin_region_code", "admin_region_name")
    return {
        "region": enrich.region_map(named, regions),
        "admin_region": admin,
        "economies": enrich.attach(
            named, admin.select("admin_region_code", "admin_region_name").distinct(), "admin_region_code"
        ),
    }


def area_codes(m49: DataFrame, economies: DataFrame, null_safe: bool = False) -> DataFrame:
    """All levels of the area hierarchy with ISO codes and, by a full join, the economies' names."""
    members = reshape.hierarchy_members(m49, schema.HIERARCHY_LEVELS)
    iso = m49.select(
        F.col("`M49 Code`").cast("string").alias("m49_code"),
        F.col("`ISO-alpha2 Code`").alias("iso_alpha2_code"),
        F.col("`ISO-alpha3 Code`").alias("iso_alpha3_code"),
    )
    named = economies.select(F.col("id").alias("iso_alpha3_code"), F.col("name").alias("world_bank_name"))
    return enrich.attach(enrich.attach(members, iso, "m49_code"), named, "iso_alpha3_code", "full", null_safe)


# ---- runs at the edge ----------------------------------------------------------------------


def run_staging(
    spark: SparkSession, paths: DataFrame, out_dir: str, allow_missing: bool = False,
    prefixes: Mapping[str, str] = schema.INDICATOR_PREFIXES,
) -> list[str]:
    """Stage every landed indicator file into ``out_dir/indicator=<code>`` and return the staged indicators.

    ``paths`` lists the landing folder (``path``). The listing is checked against the expected prefixes first.
    """
    dim = sources.prefix_dim(spark, prefixes)
    manifest = sources.landing_manifest(paths, dim)
    sources.require_landing(manifest, allow_missing)
    files = sources.with_indicator(paths, "path", dim).where(F.col("indicator").isNotNull() & F.col("location").isNull())
    landed = {r.indicator: r.path for r in files.select("indicator", "path").collect()}
    for code, path in sorted(landed.items()):
        wide = sources.read_wide_csv(spark, path)
        if code in schema.UNILATERAL_INDICATORS:
            staged = stage_unilateral(wide, typed=code == "PA3")
        elif code in schema.CLASS_INDICATORS:
            staged = stage_by_class(wide)
        else:
            staged = stage_indicator(wide)
        staged.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/indicator={code}")
    return sorted(landed)


def staged_frames(spark: SparkSession, staged_dir: str, indicators: Sequence[str]) -> dict[str, DataFrame]:
    """One frame per staged indicator, each with its own columns (class files have one more)."""
    root = staged_dir.rstrip("/")
    return {code: spark.read.parquet(f"{root}/indicator={code}") for code in indicators}


def run_flows(
    spark: SparkSession, staged: Mapping[str, DataFrame], office_codes: DataFrame, out_dir: str, export_dir: str | None = None,
    supplement: DataFrame | None = None, code_order: str | None = None, quote_all: bool = True,
) -> int:
    """Write the flows fact by indicator, and its CSV export; returns the row count."""
    fact = flows_mart(staged, office_codes, supplement, code_order=code_order)
    n = sinks.publish(fact, out_dir, ["indicator"], schema.FLOWS).rows
    if export_dir:
        sinks.export_csv(sinks.read_mart(spark, out_dir).select(*schema.FLOWS.names), export_dir, quote_all=quote_all)
    return n


def run_class_flows(
    spark: SparkSession, staged: Mapping[str, DataFrame], office_codes: DataFrame, labels: DataFrame, out_dir: str,
    export_dir: str | None = None, quote_all: bool = True, **options,
) -> int:
    """Write the class fact by indicator, and its CSV export; returns the row count."""
    fact = class_mart(staged, office_codes, labels, **options)
    n = sinks.publish(fact, out_dir, ["ip_indicator"], schema.CLASS_FLOWS).rows
    if export_dir:
        sinks.export_csv(sinks.read_mart(spark, out_dir).select(*schema.CLASS_FLOWS.names), export_dir, quote_all=quote_all)
    return n


def run_residency(
    spark: SparkSession, paths: DataFrame, out_dir: str, export_dir: str | None = None, allow_missing: bool = True, **options
) -> int:
    """Landed residency files (``…_office``, ``…_origin``) to the residency fact, and its CSV export.

    Two files for one indicator and location fail; a missing one does where ``allow_missing`` is off.
    """
    dim = sources.prefix_dim(spark)
    manifest = sources.landing_manifest(paths, dim, locations=("office", "origin"))
    sources.require_landing(manifest, allow_missing)
    located = sources.with_indicator(paths, "path", dim).where(F.col("location").isin("office", "origin"))
    landed = {r.indicator: r.path for r in located.select("indicator", "path").collect() if r.indicator}
    files = {code: sources.read_wide_csv(spark, path, repair_header=False) for code, path in sorted(landed.items())}
    n = sinks.publish(residency_mart(files, **options), out_dir, ["indicator"], schema.RESIDENCY_FLOWS).rows
    if export_dir:
        sinks.export_csv(sinks.read_mart(spark, out_dir).select(*schema.RESIDENCY_FLOWS.names), export_dir, quote_all=True)
    return n


def run_macro_flows(spark: SparkSession, paths: Mapping[str, str], out_dir: str) -> DataFrame:
    """Landed macro tables, keyed as in ``MACRO_TABLES``, to the fact; only the needed columns are parsed."""
    return sinks.materialize(macro_flows_mart({name: sources.read_delimited(spark, p, ",") for name, p in paths.items()}), out_dir)


def run_industry_trade(spark: SparkSession, raw_dir: str, out_dir: str) -> DataFrame:
    """Raw trade Parquet to the globally sorted mart."""
    mart = industry_trade_mart(stage_industry_trade(spark.read.parquet(raw_dir)))
    return sinks.materialize(mart, out_dir, view="fct_trade_by_naics_yearly", sort=INDUSTRY_ORDER)


def run_charges(spark: SparkSession, documents_path: str, out_dir: str, expected_rows: int | None = None) -> DataFrame:
    """SDMX-JSON to the gated charges mart.

    Documents are decoded once, to a stored table. The constant dimensions and the mart contract are checked on stored rows,
    before ``out_dir`` is touched: a mart that fails leaves the old one as it was.
    """
    decoded = stored(stage_charges(sources.read_sdmx_json(spark, documents_path)))
    quality.gate(quality.constants(decoded, schema.CHARGES_CONSTANTS))
    mart = stored(ip_charges_mart(clean_charges(decoded)))
    quality.gate(quality.report(mart, charges_rules(expected_rows)))
    return sinks.materialize(mart, out_dir, sort=["year", "counterpart_country"])


def run_charges_load(
    spark: SparkSession, mart_dir: str, regions: DataFrame, out_dir: str, expected_rows: int | None = None, rules: list | None = None
) -> DataFrame:
    """The charges mart to its load table: gate, guarded join to region ids, publish, verify; returns the verification row.

    No version is published unless the mart passes its contract (``rules``) and every name has a region; all names without one are
    listed in a table that the error names. The published rows are compared with the written ones by count and content.
    """
    mart = sinks.read_mart(spark, mart_dir)
    quality.gate(quality.report(mart, charges_rules(expected_rows) if rules is None else rules))
    try:
        published = sinks.publish(charges_load(mart, regions, check=False), out_dir, contract=schema.CHARGES_LOAD, verify=False)
    except Exception as e:
        if "unmatched key" in str(e):
            charges_load(mart, regions)  # fails, and lists them all
        raise
    verified = sinks.verify_written(spark, out_dir, published.content)
    if not verified.first().passed:
        raise ValueError(f"{out_dir}: the rows found are not those written")
    return verified.select("n_loaded", "n_target", "passed")
