"""Source files stood in for: extracts, code lists and the index sheet.

They are written from the driver's tables into the shared folder, once per
session and scale factor, in the layout of the published files. Geographies are
suppliers, so the extracts grow with the data.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.functions.text import month_number, month_text, semester_number
from semestra.plans.loading import Inputs, PriceSource
from semestra.reference_data import GLOBAL_CODE, PRICE_DATASETS, literal_frame
from semestra.session import new_folder
from semestra.standins.tables import YEARS, band_code, money, raw

# Periods in order, with their numbers
_SEMESTERS = {f"{y}-S{s}": 10 * y + s for y in range(YEARS[0], YEARS[1] + 1) for s in (1, 2)}
_MONTHS = {f"{y}-{m:02d}": 100 * y + m for y in range(YEARS[0], YEARS[1] + 1) for m in range(1, 13)}
_YEARS = {str(y): y for y in range(YEARS[0], YEARS[1] + 1)}
SEMESTERS, MONTHS = [*_SEMESTERS], [*_MONTHS]
DATASETS = {dataset: (commodity, consumer, siec) for dataset, commodity, consumer, siec in PRICE_DATASETS}
CALENDARS = {"years": (1990, 2005), "semesters": YEARS, "months": YEARS}

_written: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Folder of one stand-in source, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        path = new_folder(spark, name)
        _WRITERS[name](spark, sf_dir, path)
        _written[key] = path
    return _written[key]


def _write_wide(wide: DataFrame, path: str, *partition: str) -> None:
    (
        wide.write.partitionBy(*partition).option("sep", "\t").option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def _flagged(value, lines):
    """Cell text: the number, and a flag by how many lines it stands for."""
    suffix = F.when(lines == 1, "").when(lines == 2, " e").when(lines == 3, " p").otherwise(" e p")
    return F.concat(value.cast("string"), suffix)


def _series(rows: DataFrame, keys: list[str], period: str, periods: dict[str, int], cell) -> DataFrame:
    """One row per series, with one column per period; ``cell`` makes an aggregate of the
    condition that holds for the rows of a period.

    Rows go to their series first and are put together there. About as many cells as rows
    occur, so putting rows together before the shuffle would save none of it and keep the
    cells of a whole part of the file in a task's memory.
    """
    cells = [cell(F.col(period) == number).alias(name) for name, number in periods.items()]
    return rows.repartition(*keys).groupBy(*keys).agg(*cells)


def _texts(periods: list[str], missing) -> list:
    """The cells of a series as they stand in a file."""
    return [F.coalesce(F.col(f"`{p}`"), missing).alias(f"{p} ") for p in periods]


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the price extracts take from line items, with bands and the numbers of semesters."""
    orders = raw(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), semester_number(F.col("o_orderdate")).alias("semester")
    )
    parts = raw(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), band_code(F.col("p_size")).alias("band")
    )
    return raw(spark, sf_dir, "lineitem").join(parts, "l_partkey").join(orders, "l_orderkey").select(
        "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_extendedprice", "band", "semester"
    )


def _write_line_items(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Line items joined once for the extracts at fault, which are all made of them."""
    _line_items(spark, sf_dir).select("l_suppkey", "l_linenumber", "l_extendedprice", "band", "semester").write.parquet(path)


def _written_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "l_suppkey long, l_linenumber int, l_extendedprice double, band string, semester int"
    return spark.read.schema(schema).parquet(landed(spark, sf_dir, "line_items"))


def _lowest(price: str):
    """A cell with the lowest price."""
    return lambda here: F.min(F.when(here, F.col(price))).cast("string")


def _write_prices(spark: SparkSession, sf_dir: str, path: str) -> None:
    header = "freq,siec,nrg_cons,unit,tax,currency,geo\\TIME_PERIOD"
    dataset = F.expr(
        "CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'R' THEN 'nrg_pc_202' "
        "WHEN l_linestatus <> 'O' THEN 'nrg_pc_203' "
        "WHEN l_returnflag = 'R' THEN 'nrg_pc_204' ELSE 'nrg_pc_205' END"
    )
    tax = F.expr("CASE l_linenumber % 3 WHEN 0 THEN 'X_TAX' WHEN 1 THEN 'X_VAT' ELSE 'I_TAX' END")
    keys = ["dataset", "band", "tax", "l_suppkey"]
    rows = _line_items(spark, sf_dir).select(
        dataset.alias("dataset"), "band", tax.alias("tax"), "l_suppkey", "semester", money("l_extendedprice").alias("price")
    )
    wide = _series(
        rows, keys, "semester", _SEMESTERS,
        lambda here: _flagged(F.min(F.when(here, F.col("price"))), F.count(F.when(here, 1))),
    )
    siec = F.expr("CASE WHEN dataset IN ('nrg_pc_202', 'nrg_pc_203') THEN 'G3000' ELSE 'E7000' END")
    key = F.concat_ws(
        ",", F.lit("S"), siec, "band", F.lit("KWH"), "tax", F.lit("EUR"),
        F.concat(F.lit("S"), "l_suppkey"),
    )
    missing = F.when(F.col("band") == "TOT_B", ": c").otherwise(": ")
    _write_wide(wide.select("dataset", key.alias(header), *_texts(SEMESTERS, missing)), path, "dataset")


def _write_dirty_prices(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A price extract breaking the rules: annual series, a foreign product, keys
    lacking a part, an unknown tax code."""
    suppliers = raw(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"),
        F.when(F.col("s_acctbal") > 9000, "A").otherwise("S").alias("freq"),
        F.when(F.col("s_nationkey") == 3, "G3000").otherwise("E7000").alias("siec"),
        F.when(F.col("s_acctbal") >= 0, "EUR").alias("currency"),
    )
    tax = F.expr(
        "CASE WHEN l_linenumber = 7 THEN 'Z_TAX' ELSE "
        "CASE l_linenumber % 3 WHEN 0 THEN 'X_TAX' WHEN 1 THEN 'X_VAT' ELSE 'I_TAX' END END"
    )
    rows = _written_line_items(spark, sf_dir).select(
        "band", tax.alias("tax"), "l_suppkey", "semester", money("l_extendedprice").alias("price")
    )
    # A supplier given twice has its series once for each of its codes
    wide = _series(rows, ["band", "tax", "l_suppkey"], "semester", _SEMESTERS, _lowest("price")).join(suppliers.distinct(), "l_suppkey")
    key = F.concat_ws(
        ",", "freq", "siec", "band", F.lit("KWH"), "tax", "currency", F.concat(F.lit("S"), "l_suppkey")
    )
    header = "freq,siec,nrg_cons,unit,tax,currency,geo\\TIME_PERIOD"
    _write_wide(wide.select(key.alias(header), *_texts(SEMESTERS, F.lit(": "))), path)


def _written_lines(lines: DataFrame, header: str, path: str) -> None:
    """Lines as they stand, below a header in every file."""

    def below_header(batches):
        for n, batch in enumerate(batches):
            if n == 0:
                yield pa.RecordBatch.from_arrays([pa.array([header], batch.schema.field(0).type)], schema=batch.schema)
            yield batch

    lines.select("value").mapInArrow(below_header, "value string").write.text(path)


PRICE_HEADER = "freq,siec,nrg_cons,unit,tax,currency,geo\\TIME_PERIOD"


def _write_faulty_prices(spark: SparkSession, sf_dir: str, path: str) -> None:
    """An extract whose keys are right but for repeated series (nation 7); with numbers too
    large (nation 9) and lines with a cell too many (nation 11)."""
    suppliers = raw(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    rows = _written_line_items(spark, sf_dir).select("band", "l_suppkey", "semester", money("l_extendedprice").alias("price"))
    wide = _series(rows, ["band", "l_suppkey"], "semester", _SEMESTERS, _lowest("price")).join(suppliers.distinct(), "l_suppkey")
    ahead = F.when(F.col("s_nationkey") == 9, "9999999").otherwise("")
    wide = wide.withColumns({p: F.concat(ahead, F.col(f"`{p}`")) for p in SEMESTERS})
    key = F.concat_ws(
        ",", F.lit("S"), F.lit("E7000"), "band", F.lit("KWH"), F.lit("X_VAT"), F.lit("EUR"), F.concat(F.lit("S"), "l_suppkey")
    )
    more = [F.when(F.col("s_nationkey") == 11, "1")]
    line = F.concat_ws("\t", key, *[F.coalesce(F.col(f"`{p}`"), F.lit(": ")) for p in SEMESTERS], *more)
    times = F.when(F.col("s_nationkey") == 7, 2).otherwise(1)
    lines = wide.select(F.explode(F.array_repeat(line, times)).alias("value"))
    _written_lines(lines, "\t".join([PRICE_HEADER, *[f"{p} " for p in SEMESTERS]]), path)


def _write_empty_prices(spark: SparkSession, sf_dir: str, path: str) -> None:
    """A series for each supplier, without a single number."""
    key = F.concat(F.lit("S,G3000,B1,KWH,X_VAT,EUR,S"), "s_suppkey")
    wide = raw(spark, sf_dir, "supplier").select(key.alias(PRICE_HEADER), *[F.lit(": ").alias(f"{p} ") for p in SEMESTERS])
    _write_wide(wide, path)


def _write_dirty_dependency(spark: SparkSession, sf_dir: str, path: str) -> None:
    """An extract breaking the rules: quarterly series, another unit, keys lacking the unit,
    unknown products, repeated series (nation 7), numbers too large (nation 9)."""
    suppliers = raw(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey",
        F.when(F.col("s_acctbal") > 9000, "Q").otherwise("A").alias("freq"),
        F.when(F.col("s_acctbal") >= 0, F.when(F.col("s_nationkey") == 3, "THS").otherwise("PC")).alias("unit"),
    )
    parts = raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    brand = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("X"), "p_brand")).otherwise(F.col("p_brand"))
    rows = raw(spark, sf_dir, "lineitem").join(parts, "l_partkey").select(
        brand.alias("siec"), "l_suppkey", F.year("l_shipdate").alias("year"), money("l_extendedprice").alias("price")
    )
    wide = _series(rows, ["siec", "l_suppkey"], "year", _YEARS, _lowest("price")).join(suppliers.distinct(), "l_suppkey")
    ahead = F.when(F.col("s_nationkey") == 9, "9999999").otherwise("")
    key = F.concat_ws(",", "freq", "siec", "unit", F.concat(F.lit("S"), "l_suppkey"))
    line = F.concat_ws("\t", key, *[F.coalesce(F.concat(ahead, F.col(f"`{y}`")), F.lit(": ")) for y in _YEARS])
    times = F.when(F.col("s_nationkey") == 7, 2).otherwise(1)
    lines = wide.select(F.explode(F.array_repeat(line, times)).alias("value"))
    _written_lines(lines, "\t".join(["freq,siec,unit,geo\\TIME_PERIOD", *[f"{y} " for y in _YEARS]]), path)


def _write_dependency(spark: SparkSession, sf_dir: str, path: str) -> None:
    parts = raw(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("siec"))
    lines = raw(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", F.year("l_shipdate").alias("year"), money("l_extendedprice", "decimal(12,4)").alias("price")
    )
    less = F.lit(60000).cast("decimal(12,4)")

    def cell(here):
        rate = F.max(F.when(here, F.col("price"))) - less
        return _flagged(rate.cast("decimal(12,4)"), F.count(F.when(here, 1)))

    branded = _series(lines.join(parts, "l_partkey").drop("l_partkey"), ["siec", "l_suppkey"], "year", _YEARS, cell)
    # A series for each supplier: few enough to be put together before the shuffle
    totals = lines.groupBy("l_suppkey").agg(*[cell(F.col("year") == number).alias(year) for year, number in _YEARS.items()])
    wide = branded.unionByName(totals.withColumn("siec", F.lit("TOTAL")))
    key = F.concat_ws(",", F.lit("A"), "siec", F.lit("PC"), F.concat(F.lit("S"), "l_suppkey"))
    _write_wide(wide.select(key.alias("freq,siec,unit,geo\\TIME_PERIOD"), *_texts([*_YEARS], F.lit(": "))), path)


def _stock_cells(spark: SparkSession, sf_dir: str, flow: str, unit: str, geo: str):
    """Stock extract with its codes given as SQL over line items and suppliers."""
    suppliers = raw(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    rows = raw(spark, sf_dir, "lineitem").join(suppliers, "l_suppkey").select(
        F.expr(flow).alias("flow"), F.expr(unit).alias("unit"), F.expr(geo).alias("geo"),
        month_number(F.col("l_shipdate")).alias("month"), "l_quantity",
    )
    wide = _series(
        rows, ["flow", "unit", "geo"], "month", _MONTHS,
        lambda here: F.sum(F.when(here, F.col("l_quantity"))).cast("decimal(14,4)").cast("string"),
    )
    key = F.concat_ws(",", F.lit("M"), "flow", "unit", "geo")
    return wide.select(key.alias("freq,stk_flow,unit,geo\\TIME_PERIOD"), *_texts(MONTHS, F.lit(": ")))


FLOW = (
    "CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'IC_DC' WHEN 'AO' THEN 'IMP_DNC' "
    "WHEN 'NF' THEN 'STK_EUE_DIR' WHEN 'NO' THEN 'STK_MIN_CAL' WHEN 'RF' THEN 'STK_EUE_MTH' ELSE '{other}' END"
)
CLEAN_FLOW = FLOW.format(other="STK_EUE_MIN_MTH")
DIRTY_FLOW = FLOW.format(other="STK_OTHER")
UNIT = "CASE WHEN l_returnflag || l_linestatus = 'NF' THEN 'NR' ELSE 'THS_T' END"
DIRTY_UNIT = f"CASE WHEN l_linenumber = 7 THEN 'NR' ELSE {UNIT} END"
GEO = "'S' || l_suppkey"
DIRTY_GEO = "CASE WHEN s_acctbal < 0 THEN 'X' ELSE 'S' END || l_suppkey"


def _write_stocks(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_wide(_stock_cells(spark, sf_dir, CLEAN_FLOW, UNIT, GEO), path)


def _write_dirty_stocks(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_wide(_stock_cells(spark, sf_dir, DIRTY_FLOW, DIRTY_UNIT, DIRTY_GEO), path)


def _write_index(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Monthly sheet: highest, lowest and their distance."""
    high, low = F.max(money("o_totalprice")), F.min(money("o_totalprice"))
    rows = (
        raw(spark, sf_dir, "orders").groupBy(month_text(month_number(F.col("o_orderdate"))).alias("m"))
        .agg(high.alias("GPR"), low.alias("GPRT"), (high - low).cast("decimal(14,4)").alias("GPRA"))
        .select(F.concat("m", F.lit("-01")).alias("month"), "GPR", "GPRT", "GPRA")
    )
    rows.write.option("header", True).csv(path)


def _write_dirty_index(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One row per order: blank rows, partial rows, unreadable dates, repeated months."""
    urgent = "o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'"
    blank = "o_orderpriority = '4-NOT SPECIFIED'"
    partial = "o_orderpriority = '5-LOW' AND o_orderstatus = 'P'"
    price = "CAST(CAST(o_totalprice AS DECIMAL(14,4)) AS STRING)"
    rows = raw(spark, sf_dir, "orders").select(
        F.expr(f"CASE WHEN {urgent} THEN 'n/a' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END").alias("Month "),
        F.expr(f"CASE WHEN {blank} THEN NULL ELSE {price} END").alias("GPR"),
        F.expr(f"CASE WHEN {blank} OR {partial} THEN NULL ELSE {price} END").alias("GPRT"),
        F.expr(f"CASE WHEN {blank} THEN NULL ELSE {price} END").alias("GPRA"),
        F.col("o_orderstatus").alias("GPRC_XX"),
    )
    (
        rows.write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )


def _write_codelists(rows: DataFrame, path: str) -> None:
    """``codelist, place, code, names`` as an SDMX-like structure file. Code lists are
    short by nature, so each is gathered into one element."""
    entry = F.struct("place", F.col("code").alias("_id"), F.col("names").alias("Name"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.struct(e["_id"], e["Name"]))
    lists = rows.groupBy(F.col("codelist").alias("_id")).agg(ordered.alias("Code"))
    lists.write.format("xml").option("rowTag", "Codelist").option("rootTag", "Codelists").save(path)


def _name(language: str, text):
    return F.struct(F.lit(language).alias("_lang"), text.alias("_VALUE"))


# Fixed values of the stand-in extracts: list -> codes in document order
_PRICE_CODES = {
    "SIEC": ["G3000", "E7000"],
    "NRG_CONS": ["TOT_B", "B1", "B2", "B3", "B4"],
    "TAX": ["X_TAX", "X_VAT", "I_TAX"],
    "UNIT": ["KWH", "GJ_GCV"],
    "CURRENCY": ["EUR", "PPS"],
}


# Fixed values of the faulty lists: codes and a whole list are lacking, an unranked tax code is there
_FAULTY_CODES = {
    "SIEC": ["E7000"],
    "NRG_CONS": ["TOT_B", "B1", "B2", "B3"],
    "TAX": ["X_TAX", "X_VAT", "Z_TAX"],
    "UNIT": ["GJ_GCV"],
}


def _write_faulty_codelists(spark: SparkSession, sf_dir: str, path: str) -> None:
    _write_price_codelists(spark, sf_dir, path, _FAULTY_CODES)


def _write_faulty_products(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Products without the list of units."""
    brands = raw(spark, sf_dir, "part").select(
        F.lit("SIEC").alias("codelist"), F.expr("CAST(substring(p_brand, 7) AS INT)").alias("place"), F.col("p_brand").alias("code"),
    ).distinct()
    _write_codelists(brands.withColumn("names", F.array(_name("en", F.concat(F.lit("Product "), "code")))), path)


def _write_price_codelists(spark: SparkSession, sf_dir: str, path: str, lists: dict[str, list[str]] = _PRICE_CODES) -> None:
    rows = [
        (codelist, place, code)
        for codelist, codes in lists.items()
        for place, code in enumerate(codes)
    ]
    code = F.col("code")
    names = F.array(
        _name("de", F.concat(F.lit("Kode "), code)), _name("en", F.concat(F.lit("Code "), code))
    )
    frame = literal_frame(spark, rows, "codelist string, place int, code string")
    _write_codelists(frame.withColumn("names", names), path)


def _write_dependency_codelists(spark: SparkSession, sf_dir: str, path: str) -> None:
    brands = raw(spark, sf_dir, "part").select(
        F.lit("SIEC").alias("codelist"), F.expr("CAST(substring(p_brand, 7) AS INT)").alias("place"),
        F.col("p_brand").alias("code"),
    ).distinct()
    others = literal_frame(
        spark, [("SIEC", 0, "TOTAL"), ("UNIT", 0, "PC")], "codelist string, place int, code string"
    )
    names = F.array(_name("en", F.concat(F.lit("Product "), "code")))
    _write_codelists(brands.unionByName(others).withColumn("names", names), path)


def _write_part_codelists(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One list per brand but Brand#2, its codes the part sizes: most named in two
    languages, those over 40 in French only, size 50 without a name."""
    size = F.col("p_size").cast("string")
    names = F.when(
        F.col("p_size") <= 40,
        F.array(_name("de", F.concat(F.lit("Klasse "), size)), _name("en", F.concat(F.lit("Class "), size))),
    ).when(
        F.col("p_size") < 50, F.array(_name("fr", F.concat(F.lit("Classe "), size)))
    ).otherwise(F.array(_name("en", F.lit(""))))
    rows = (
        raw(spark, sf_dir, "part").filter(F.col("p_brand") != "Brand#2")
        .select("p_brand", "p_size").distinct()
        .select(F.col("p_brand").alias("codelist"), F.col("p_size").alias("place"), size.alias("code"), names.alias("names"))
    )
    _write_codelists(rows, path)


_WRITERS: dict[str, Callable[[SparkSession, str, str], None]] = {
    "line_items": _write_line_items,
    "prices": _write_prices,
    "prices_dirty": _write_dirty_prices,
    "prices_faulty": _write_faulty_prices,
    "prices_empty": _write_empty_prices,
    "dependency_dirty": _write_dirty_dependency,
    "faulty_codelists": _write_faulty_codelists,
    "faulty_products": _write_faulty_products,
    "dependency": _write_dependency,
    "stocks": _write_stocks,
    "stocks_dirty": _write_dirty_stocks,
    "index": _write_index,
    "index_dirty": _write_dirty_index,
    "price_codelists": _write_price_codelists,
    "dependency_codelists": _write_dependency_codelists,
    "part_codelists": _write_part_codelists,
}


def price_sources(spark: SparkSession, sf_dir: str) -> list[PriceSource]:
    prices, codelists = landed(spark, sf_dir, "prices"), landed(spark, sf_dir, "price_codelists")
    return [
        PriceSource(name, f"{prices}/dataset={name}", codelists, commodity, consumer, siec)
        for name, (commodity, consumer, siec) in DATASETS.items()
    ]


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return Inputs(
        prices=price_sources(spark, sf_dir),
        dependency=landed(spark, sf_dir, "dependency"),
        dependency_codelists=landed(spark, sf_dir, "dependency_codelists"),
        stocks=landed(spark, sf_dir, "stocks"),
        index=landed(spark, sf_dir, "index"),
    )


def supplier_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as countries, plus the global member; no keys yet."""
    none = F.lit(None).cast("string")
    suppliers = raw(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("eurostat_code"), none.alias("iso_alpha2"),
        none.alias("iso_alpha3"), F.col("s_name").alias("country_name"),
        F.lit("Country").alias("entity_type"), F.lit(False).alias("is_eu"),
    )
    world = literal_frame(
        spark, [(GLOBAL_CODE, None, None, "World", "Global", False)],
        "eurostat_code string, iso_alpha2 string, iso_alpha3 string, country_name string, "
        "entity_type string, is_eu boolean",
    )
    return suppliers.unionByName(world)


def supplier_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are members from their first shipment; those in debt left in 2000."""
    first = raw(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.min(F.year("l_shipdate")).alias("entry_year"))
    suppliers = raw(spark, sf_dir, "supplier").withColumnRenamed("s_suppkey", "l_suppkey")
    return first.join(suppliers, "l_suppkey").select(
        F.concat(F.lit("S"), "l_suppkey").alias("code"), "entry_year",
        F.when(F.col("s_acctbal") < 0, 2000).alias("exit_year"),
    )
