"""Raw listing rows derived from order, customer, nation and supplier tables.

The tables hold no listings, so their columns are dressed up as ones: names with
business, estate and trust forms, amounts as plain text, with signs or as ranges,
addresses in parts, in one line or missing, and repeats across sources.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadmill.sources.mappings import LISTING, KeyMapping, Registry
from leadmill.sources.raw import batch_id, wrap_raw

# A second listing layout, and a short one without street or amount ranges.
PAYEE_LISTING = KeyMapping(
    owner_name="payee",
    address_line1="street",
    city="town",
    state="region",
    zip="postcode",
    claim_amount_text="value",
    property_type="kind",
    amount_ranges=True,
    name_keywords=True,
)
SHORT_LISTING = KeyMapping(
    owner_name="owner_name", city="city", state="state", claim_amount_text="claim_amount"
)

REGISTRY: Registry = {
    "src_a": LISTING,
    "src_b": PAYEE_LISTING,
    "src_s": SHORT_LISTING,
}
UNREGISTERED = "src_unregistered"

LISTING_CELLS = [
    "property_id",
    "owner_name",
    "owner_address",
    "owner_city",
    "owner_state",
    "owner_zip",
    "claim_amount",
    "property_type_description",
    "reported_year",
]
_PAYEE_NAMES = {
    "owner_name": "payee",
    "owner_address": "street",
    "owner_city": "town",
    "owner_state": "region",
    "owner_zip": "postcode",
    "claim_amount": "value",
    "property_type_description": "kind",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def order_listings(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """One listing per order, plus a second one for every 23rd order key."""
    if orders is None:
        orders = table(spark, sf_dir, "orders")
    joined = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))

    by_customer = F.col("o_custkey") % 10
    name = F.col("c_name")
    owner = (
        F.when(by_customer == 0, F.concat(F.lit("estate of "), name))
        .when(by_customer == 1, F.concat(name, F.lit(" LLC")))
        .when(by_customer == 2, F.concat(name, F.lit("  family   trust")))
        .when(by_customer == 3, F.concat(F.lit("heir of "), name))
        .when(by_customer == 4, F.concat(name, F.lit(" Co.")))
        .when(by_customer == 5, F.concat(name, F.lit(",")))
        .when(by_customer == 6, F.lit("  "))
        .otherwise(name)
    )

    street = F.concat(
        _text(F.col("o_custkey") % 97), F.lit(" "), F.col("c_mktsegment"), F.lit(" St")
    )
    state = (
        F.when(F.col("n_regionkey") == 0, "tx")
        .when(F.col("n_regionkey") == 1, " ny ")
        .otherwise("CA")
    )
    zip_code = F.lpad(_text("o_custkey"), 5, "0")
    one_line = F.concat_ws(
        ", ", street, F.col("n_name"), F.concat(F.trim(state), F.lit(" "), zip_code)
    )
    # 0: everything in one line; 1: one line of another shape; 2: one line beside
    # a given city; 3: no address at all; else separate parts.
    form = F.col("o_custkey") % 13
    parts = form > 3
    address = (
        F.when(form.isin(0, 2), one_line)
        .when(form == 1, F.concat(F.lit("PO Box "), _text("o_custkey")))
        .when(parts, street)
    )

    fraction = (
        F.when(F.col("o_orderkey") % 5 == 0, F.lit("1"))
        .when(F.col("o_orderkey") % 5 == 1, F.lit("0.05"))
        .when(F.col("o_orderkey") % 5 == 2, F.lit("0.01"))
        .when(F.col("o_orderkey") % 5 == 3, F.lit("0.002"))
        .otherwise(F.lit("0.0002"))
        .cast("decimal(5,4)")
    )
    price = F.col("o_totalprice").cast("decimal(14,2)")
    number = _text((price * fraction).cast("decimal(14,2)"))
    wording = F.col("o_orderkey") % 8
    amount = (
        F.when(wording == 0, F.lit(""))
        .when(wording == 1, F.concat(F.lit("AMOUNT INDICATED IS AT LEAST $"), number))
        .when(wording == 2, F.concat(F.lit("BETWEEN $"), number, F.lit(" AND $9")))
        .when(wording == 3, F.concat(F.lit("$"), number))
        .when(wording == 4, F.lit("n/a"))
        .otherwise(number)
    )

    by_order = F.col("o_orderkey") % 3
    source = (
        F.when(by_order == 0, "src_a").when(by_order == 1, "src_b").otherwise(UNREGISTERED)
    )
    listings = joined.select(
        (F.col("o_orderkey") * 2).alias("seq"),
        source.alias("source"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("listed_at"),
        F.concat(F.lit("P-"), _text("o_orderkey")).alias("property_id"),
        owner.alias("owner_name"),
        address.alias("owner_address"),
        F.when(parts | (form == 2), F.col("n_name")).alias("owner_city"),
        F.when(parts, state).alias("owner_state"),
        F.when(parts, zip_code).alias("owner_zip"),
        amount.alias("claim_amount"),
        F.concat(F.lit(" "), F.col("o_orderpriority")).alias("property_type_description"),
        _text(F.year("o_orderdate")).alias("reported_year"),
        (F.col("o_orderkey") % 23 == 0).alias("repeated"),
    )
    # The repeat comes from the other source, where the row itself is emitted once
    # and once more by exploding, so the tables are read and joined once.
    copies = F.when(F.col("repeated"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    exploded = listings.withColumn("copy", F.explode(copies))
    return exploded.select(
        (F.col("seq") + F.col("copy")).alias("seq"),
        F.when(F.col("copy") == 1, "src_b").otherwise(F.col("source")).alias("source"),
        "listed_at",
        *LISTING_CELLS,
    )


def freeform_addresses(
    spark: SparkSession, sf_dir: str, orders: DataFrame
) -> DataFrame:
    """``o_orderkey, written``: one address an order, in one of ten forms."""
    joined = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    number = _text(F.col("o_custkey") % 97 + 1)
    street = F.concat_ws(" ", number, F.initcap("c_mktsegment"), F.lit("St"))
    # The names hold digits, which no city has.
    city = F.initcap(F.translate("n_name", "0123456789_", "abcdefghij "))
    state = F.when(F.col("n_regionkey") == 0, "TX").otherwise("NY")
    zip_code = F.lpad(_text("o_custkey"), 5, "0")
    unit = _text(F.col("o_orderkey") % 40)

    def text(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])

    forms = [
        text(street, ", ", city, ", ", state, " ", zip_code),
        text(street, ", ", city, ", ", state),
        text(street, " ", city, " ", state, " ", zip_code),
        text(street, " Apt ", unit, "B, ", city, ", ", state, " ", zip_code),
        text(street, ", Ste ", unit, ", ", city, " ", state, " ", zip_code),
        text("PO Box ", unit, ", ", city, ", ", state, " ", zip_code),
        text("P.O. Box ", unit, " ", city, " ", state, " ", zip_code),
        text(street, " NW # ", unit, " ", city, " ", state, " ", zip_code, "-0001"),
        text(street, ",  ", city),
        text(" ", street),
    ]
    form = F.col("o_orderkey") % len(forms)
    written = forms[0]
    for number_of, made in enumerate(forms):
        written = F.when(form == number_of, made).otherwise(written)
    return joined.select("o_orderkey", written.alias("written"))


def _wrap(listings: DataFrame, cells: list[str]) -> DataFrame:
    """Raw rows in yearly batches."""
    year_start = F.date_trunc("year", "listed_at")
    return wrap_raw(
        listings,
        source=F.col("source"),
        file_batch_id=batch_id(F.col("source"), year_start, F.lit("00000000")),
        ingested_at=F.col("listed_at"),
        cells=cells,
        seq=F.col("seq"),
    )


def order_claims(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """Raw rows of the order listings; ``src_b`` rows have its own cell names."""
    raw = _wrap(order_listings(spark, sf_dir, orders), LISTING_CELLS)
    renamed = []
    for name in LISTING_CELLS:
        renamed += [
            F.lit(_PAYEE_NAMES.get(name, name)),
            F.try_element_at("raw_data", F.lit(name)),
        ]
    cells = F.when(F.col("source") == "src_b", F.create_map(*renamed)).otherwise(
        F.col("raw_data")
    )
    return raw.withColumn("raw_data", cells)


def supplier_claims(
    spark: SparkSession, sf_dir: str, suppliers: DataFrame | None = None
) -> DataFrame:
    """Raw rows of suppliers in the short layout."""
    if suppliers is None:
        suppliers = table(spark, sf_dir, "supplier")
    suppliers = suppliers.join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    listings = suppliers.select(
        (F.col("s_suppkey") * 2).alias("seq"),
        F.lit("src_s").alias("source"),
        F.lit("1999-01-01 00:00:00").cast("timestamp_ntz").alias("listed_at"),
        F.concat(F.col("s_name"), F.lit(" Holdings")).alias("owner_name"),
        F.col("n_name").alias("city"),
        F.lit("ny").alias("state"),
        _text(F.col("s_acctbal").cast("decimal(14,2)")).alias("claim_amount"),
    )
    return _wrap(listings, ["owner_name", "city", "state", "claim_amount"])


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows."""
    return order_claims(spark, sf_dir).unionByName(supplier_claims(spark, sf_dir))
