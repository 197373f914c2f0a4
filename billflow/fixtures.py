"""Inputs derived from the test tables by fixed arithmetic, so results can be predicted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BAD_DATE = "2023-13-45"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bills(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One bill header per order. ``spread`` deals the orders over all cores by key before their texts are made:
    the test tables are single files of one row group, which one task would read and turn into bills; real
    payloads arrive in many splits and need no such step."""
    k = F.col("k")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), "o_custkey", "o_orderdate", "o_totalprice")
    if spread:
        orders = orders.repartition(spark.sparkContext.defaultParallelism, "k")
    return orders.select(
        "k", F.concat(F.lit("bill_"), k.cast("string"), F.lit(".jpg")).alias("file"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("vendor_name"),
        F.concat(F.lit("INV-"), k.cast("string")).alias("invoice_number"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.col("o_totalprice").alias("total_amount"), ((k % 500) / F.lit(4.0)).alias("tax_amount"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, items): an order's lines as one sorted list; a bill holds its own lines."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    lines = table(spark, sf_dir, "lineitem").join(
        part, F.col("l_partkey") == F.col("p_partkey"))
    return lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.sort_array(F.collect_list(
        F.struct(F.col("p_name").alias("product_desc"), F.col("l_quantity").alias("quantity"),
                 F.col("l_extendedprice").alias("total_price")))).alias("items"))


def document_class(items: Column | None) -> Column:
    k = F.col("k")
    found = (F.when(k % 29 == 2, "json").when(k % 11 == 3, "total_text")
             .when(k % 13 == 5, "vendor_missing"))
    if items is not None:
        found = found.when((k % 23 == 8) & (F.size(items) > 0), "item_desc_missing")
    return (found.when(k % 19 == 6, "bad_date").when(k % 17 == 4, "total_numeric_text")
            .otherwise("ok"))


def documents(spark: SparkSession, sf_dir: str, items: bool = True,
              changed: bool = False) -> DataFrame:
    """Raw payloads (k, file_name, seq, raw) with one fixed corruption per class.

    ``changed`` gives a second delivery: for k % 7 = 0 the tax is one higher and the number
    gets a suffix, for k % 7 = 1 the tax is null, otherwise nothing differs.
    """
    rows, k = bills(spark, sf_dir, spread=True), F.col("k")
    if items:
        rows = rows.join(order_items(spark, sf_dir), "k", "left").withColumn(
            "items", F.coalesce("items", F.array()))
    rows = rows.withColumn("class", document_class(F.col("items") if items else None))
    tax = F.col("tax_amount").cast("string")
    number = F.col("invoice_number")
    if changed:
        tax = F.when(k % 7 == 0, (F.col("tax_amount") + 1).cast("string")).when(
            k % 7 == 1, "null").otherwise(tax)
        number = F.when(k % 7 == 0, F.concat(number, F.lit("-B"))).otherwise(number)
    kind = F.col("class")
    total = F.when(kind == "total_text", '"forty and a half"').when(
        kind == "total_numeric_text", F.concat(F.lit('"'), F.col("total_amount"), F.lit('"'))
    ).otherwise(F.col("total_amount").cast("string"))

    def member(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value)

    def text(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    parts = [
        F.when(kind != "vendor_missing", member("vendor_name", text(F.col("vendor_name")))),
        member("invoice_number", text(number)),
        member("invoice_date", text(F.when(kind == "bad_date", BAD_DATE)
                                    .otherwise(F.col("date")))),
        member("total_amount", total), member("tax_amount", tax)]
    if items:
        listed = F.transform("items", lambda item, i: F.struct(
            F.when(~((kind == "item_desc_missing") & (i == 0)), item["product_desc"])
            .alias("product_desc"),
            item["quantity"].alias("quantity"), item["total_price"].alias("total_price")))
        parts.append(member("line_items", F.to_json(listed)))
    whole = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    raw = F.when(kind == "json", F.substring(whole, F.lit(1), (F.length(whole) / 2).cast("int"))
                 ).otherwise(whole)
    return rows.select("k", F.col("file").alias("file_name"),
                       (k + (1_000_000_000 if changed else 0)).alias("seq"), raw.alias("raw"))


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, extracted, truth): vendor names with eight kinds of damage."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("k"), F.col("p_name").alias("truth"))
    size = part.agg(F.count(F.lit(1))).scalar()
    following = part.select((F.pmod(F.col("k") - 1 + size, size)).alias("k"),
                            F.col("truth").alias("following"))
    k, name = F.col("k"), F.col("truth")
    n = F.length(name)
    damaged = (
        F.when(k % 8 == 0, name)
        .when(k % 8 == 1, F.concat(F.upper(name), F.lit(" Pvt. Ltd.")))
        .when(k % 8 == 2, F.substring(name, F.lit(1), n - 1))
        .when(k % 8 == 3, F.concat(F.substring(name, 1, 1), F.substring(name, F.lit(3), n)))
        .when(k % 8 == 4, F.concat(F.substring(name, 1, 1), F.substring(name, 3, 1),
                                   F.substring(name, 2, 1), F.substring(name, F.lit(4), n)))
        .when(k % 8 == 5, F.col("following"))
        .when(k % 8 == 6, ""))
    return part.join(following, "k").select("k", damaged.alias("extracted"), "truth")


def field_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracted and true amounts, dates and tax ids of each order."""
    k, total = F.col("k"), F.col("total_amount")
    comma = F.concat(F.floor(total / 1000).cast("string"), F.lit(","),
                     F.lpad(F.floor(total % 1000).cast("string"), 3, "0"))
    amount = (
        F.when(k % 6 == 0, total.cast("string")).when(k % 6 == 1, F.concat(F.lit(" "), total))
        .when(k % 6 == 2, comma).when(k % 6 == 3, F.concat(F.lit("R"), total))
        .when(k % 6 == 4, F.round(total + 0.3, 2).cast("string")))
    day = F.to_date("date")
    date = (
        F.when(k % 4 == 0, F.col("date"))
        .when(k % 4 == 1, F.date_format(F.date_add(day, 1), "yyyy-MM-dd"))
        .when(k % 4 == 2, F.date_format(day, "dd/MM/yyyy")))
    gstin = gstin_of(k)
    return bills(spark, sf_dir).select(
        "k", total.alias("amount_truth"), amount.alias("amount"),
        F.col("date").alias("date_truth"), date.alias("date"),
        F.when(k % 4 == 3, "Unspecified").otherwise(gstin).alias("gstin_truth"),
        F.when(k % 4 == 0, gstin).when(k % 4 == 1, gstin_of(k + 1))
        .when(k % 4 == 2, F.lower(gstin)).otherwise("Unspecified").alias("gstin"))


def gstin_of(k: Column) -> Column:
    return F.concat(F.lpad((k % 38).cast("string"), 2, "0"), F.lit("ABCDE"),
                    F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("F1Z5"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ground truth of every bill but those with k % 53 = 0."""
    k = F.col("k")
    return _with_gstin(bills(spark, sf_dir, spread=True)).where(k % 53 != 0).select(
        "file", "vendor_name", "invoice_number", "date", "total_amount", "tax_amount", "gstin")


def _with_gstin(rows: DataFrame) -> DataFrame:
    k = F.col("k")
    return rows.withColumn("gstin", F.when(k % 4 == 3, "Unspecified").otherwise(gstin_of(k)))


def model_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(k, file, payload, error) of three models: one perfect, two with fixed faults."""
    rows, k = _with_gstin(bills(spark, sf_dir, spread=True)), F.col("k")
    fields = ("vendor_name", "invoice_number", "date", "total_amount", "tax_amount", "gstin")

    def output(changes: dict[str, Column], failed: Column | None = None) -> DataFrame:
        values = [changes.get(f, F.col(f)).alias(f) for f in fields]
        error = F.lit(None).cast("string") if failed is None else F.when(failed, "model failed")
        return rows.select("k", "file", error.alias("error"), F.when(
            error.isNull(), F.to_json(F.struct(*values))).alias("payload"))

    shifted = F.date_format(F.date_add(F.to_date("date"), 1), "yyyy-MM-dd")
    return {
        "m_a": output({}),
        "m_b": output({
            "date": F.when(k % 5 == 0, shifted).otherwise(F.col("date")),
            "invoice_number": F.when(k % 8 != 0, F.col("invoice_number"))}, k % 37 == 1),
        "m_c": output({
            "total_amount": F.when(k % 2 == 0, F.round(F.col("total_amount") + 10, 2))
            .otherwise(F.col("total_amount")),
            "vendor_name": F.when(k % 9 == 0, "").otherwise(F.col("vendor_name"))},
        ).where(k % 41 != 2),
    }


