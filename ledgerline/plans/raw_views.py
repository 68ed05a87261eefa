"""Raw report cells derived by Spark from the given tables.

These stand in for report files: every cell is a string, free-text cells
are padded with white space, and in the SD view some rows are "shifted"
the way a separator inside a free-text cell shifts a CSV row.  The clean
values are simple functions of the source columns, so an oracle can state
the expected result directly.

The shift kind of an order is ``(o_orderkey DIV 6) % 6`` and the document
type ``o_orderkey % 6``, so both vary independently.  Every 17th order is
duplicated, to exercise de-duplication.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.spec import OS_SPEC, SD_SPEC


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dmy(d: Column) -> Column:
    return F.date_format(d, "dd/MM/yyyy")


def _pad(c: Column, k: Column) -> Column:
    return F.when(k % 5 == 0, F.concat(F.lit("\t "), c, F.lit("\u00a0"))).otherwise(c)


# Raw document-type spellings by ``o_orderkey % 6`` (5 is null).
RAW_DOC_TYPES = ("RUC 20", "PASAPORTE", "CARNET EXT.", "DNI", "RUC PAS")


def _doc_type(k: Column) -> Column:
    doc = k % 6
    out = F.when(doc == 0, F.lit(RAW_DOC_TYPES[0]))
    for i, v in enumerate(RAW_DOC_TYPES[1:], start=1):
        out = out.when(doc == i, F.lit(v))
    return out


def order_customer(spark: SparkSession, sf_dir: str, keyed: DataFrame | None = None) -> DataFrame:
    """orders x customer x nation, keeping only the columns the views use.

    ``nation`` is tiny and broadcast by the planner's size threshold;
    ``customer`` joins on its key (sort-merge at scale, co-partitioned with
    the order side by the exchange).
    """
    o = keyed if keyed is not None else table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, c.c_nationkey == n.n_nationkey)
             .drop("o_custkey", "n_nationkey"))


def sd_clean_cells(base: DataFrame) -> DataFrame:
    """Clean SD cells (unpadded) plus the parts that a shift splits apart."""
    k = F.col("k")
    kind = F.expr("k div 6") % 6
    od = F.col("o_orderdate").cast("date")
    three = kind.isin(4, 5)
    cb = F.col("c_nationkey").cast("string")
    return base.select(
        k, kind.alias("kind"),
        _doc_type(k).alias("TIPO_DOC"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("NRO_DOC"),
        F.col("c_name").alias("N1"),
        F.when(three, F.col("c_mktsegment")).otherwise(F.lit("SA")).alias("N2"),
        F.lit("SA").alias("N3"),
        F.when(three, F.lit(None).cast("string"))
         .when(k % 13 == 0, F.lit("00/00/0000"))
         .otherwise(_dmy(F.date_sub(od, (F.lit(7300) + k % 9000).cast("int")))).alias("FN"),
        F.col("o_orderstatus").alias("TE"),
        F.when((kind == 0) & (k % 7 == 0), F.lit(None).cast("string"))
         .otherwise(F.concat(_dmy(od), F.lit(" 10:11:12"))).alias("FR"),
        F.col("o_orderpriority").alias("FU"),
        F.col("n_name").alias("NA"),
        F.col("c_mktsegment").alias("RA"),
        cb.alias("CB"),
        F.lit("BK").alias("BK1"), cb.alias("BK2"),
        _dmy(F.date_add(od, 30)).alias("VD"),
        F.when(k % 3 == 0, F.lit(None).cast("string"))
         .when(k % 3 == 1, F.lit("  "))
         .otherwise(_dmy(F.date_add(od, 365))).alias("VH"),
        F.concat(F.lit("U"), (k % 50).cast("string")).alias("US"),
        _dmy(F.date_add(od, 1)).alias("RD"),
    )


def _shifted_array(kind: Column, k: Column) -> Column:
    """The 13 movable raw cells of each shift kind, as one array."""
    c = F.col
    n1 = F.when(k % 5 == 0, F.concat(F.lit(" "), c("N1"))).otherwise(c("N1"))
    name1 = F.concat(c("N1"), F.lit(" "), c("N2"))
    name3 = F.concat(c("N1"), F.lit(","), c("N2"), F.lit(","), c("N3"))
    bk_space = F.concat(c("BK1"), F.lit(" "), c("BK2"))
    bk_comma = F.concat(c("BK1"), F.lit(","), c("BK2"))
    rest = [c("TE"), c("FR"), c("FU"), c("NA"), c("RA"), c("CB")]
    layouts = {
        0: [_pad(name1, k), c("FN"), *rest, bk_space, c("VD"), c("VH"), c("US"), c("RD")],
        1: [n1, c("N2"), c("FN"), *rest, bk_space, c("VD"), c("VH"), c("US")],
        2: [n1, c("N2"), c("FN"), *rest, c("BK1"), c("BK2"), c("VD"), c("VH")],
        3: [_pad(name1, k), c("FN"), *rest, c("BK1"), c("BK2"), c("VD"), c("VH"), c("US")],
        4: [n1, c("N2"), c("N3"), c("FN"), *rest, bk_space, c("VD"), c("VH")],
        5: [n1, c("N2"), c("N3"), c("FN"), *rest, c("BK1"), c("BK2"), c("VD")],
    }
    arr = None
    for kd, cells in layouts.items():
        a = F.array(*cells)
        arr = F.when(kind == kd, a) if arr is None else arr.when(kind == kd, a)
    return arr


def sd_raw(spark: SparkSession, sf_dir: str, base: DataFrame | None = None) -> DataFrame:
    """SD report as read from day-first text files: ``row_id`` + 15 raw cells."""
    cells = sd_clean_cells(base if base is not None else order_customer(spark, sf_dir))
    k = F.col("k")
    shifted = cells.select(
        k.alias("row_id"), F.col("TIPO_DOC"), _pad(F.col("NRO_DOC"), k).alias("NRO_DOC"),
        _shifted_array(F.col("kind"), k).alias("cells"))
    raw = _twice_every_17th(shifted, F.col("row_id"))
    return raw.select("row_id", "TIPO_DOC", "NRO_DOC",
                      *[F.get("cells", i).alias(n) for i, n in enumerate(SD_SPEC.raw_names[2:])])


def _twice_every_17th(df: DataFrame, k: Column) -> DataFrame:
    """Every 17th row twice, in one pass (no second scan of the inputs)."""
    copies = F.when(k % 17 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("__copy", F.explode(copies)).drop("__copy")


def sd_raw_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same layout with one row per line item (bench scale: ~6M rows per SF)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    keyed = li.join(o, li.l_orderkey == o.o_orderkey).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"),
        "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return sd_raw(spark, sf_dir, order_customer(spark, sf_dir, keyed))


def os_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OS report cells: 10 raw strings per order, every 17th order twice."""
    base = order_customer(spark, sf_dir)
    k = F.col("k")
    od = F.col("o_orderdate").cast("date")
    carta = F.date_add(od, 10)
    raw = base.select(
        k.alias("row_id"),
        _pad(k.cast("string"), k).alias("ID"),
        _doc_type(k).alias("TIPO_DOC"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("NRO_DOC"),
        _pad(F.col("c_name"), k + 1).alias("NOMBRE_CLIENTE"),
        F.when(k % 23 == 0, F.lit(None).cast("string")).otherwise(_dmy(od)).alias("FECHA_CREA"),
        F.when(k % 4 == 0, F.concat(_dmy(carta), F.lit(" 09:30")))
         .when(k % 4 == 1, F.lit(""))
         .when(k % 4 == 2, F.lit("31/02/2024"))
         .otherwise(F.concat(F.date_format(carta, "d/M/yyyy"), F.lit(" 10:00"))).alias("FECHA_CARTA"),
        F.concat(F.lit("BK "), F.col("c_nationkey").cast("string")).alias("BROKER"),
        F.when(k % 5 == 1, F.lit("")).otherwise(F.concat(F.lit("U"), (k % 50).cast("string")))
         .alias("USUARIO_CREA"),
        F.when(k % 6 == 2, F.lit("  ")).otherwise(F.concat(F.lit("C"), (k % 30).cast("string")))
         .alias("USUARIO_CARTA"),
        F.col("o_orderstatus").alias("ESTADO_CARTA"),
    )
    assert raw.columns[1:] == list(OS_SPEC.raw_names)
    return _twice_every_17th(raw, F.col("row_id"))


def write_csv_reports(raw: DataFrame, names, folder: str, files: int, wrap_every: int = 10,
                      key: str = "row_id") -> str:
    """Write raw cells as CSV report files (header line, comma separated,
    RFC quoting; every ``wrap_every``-th line wrapped whole in quotes).

    The lines are formed by Spark and written as text through the CSV
    writer with quoting off, so each file gets its header line.
    """
    names = list(names)
    line = F.to_csv(F.struct(*[F.col(n) for n in names]), {"nullValue": "", "quote": '"', "escape": '"'})
    wrapped = F.concat(F.lit('"'), F.replace(line, F.lit('"'), F.lit('""')), F.lit('"'))
    out = raw.select(F.when(F.col(key) % wrap_every == 0, wrapped).otherwise(line).alias(",".join(names)))
    (out.repartition(files).write.mode("overwrite").option("header", True).option("sep", "\u0001")
        .option("quote", "").option("escape", "").csv(folder))
    return folder
