"""The query catalogue: one entry per reference query, bound to the driver tables.

Each entry is ``fn(spark, sf_dir) -> DataFrame`` and is lazy except those whose
point is to write something and read it back (``category_revenue``, ``word_freq_csv``,
``web_word_export_csv``, ``word_freq_lines``, ``lines_*``) and ``country_summary*``,
``word_ranks``, ``top_words_sketched``, ``preview_one_pass`` and ``star_join_stored``, which
store intermediate tables in the shared folder.  Where the
reference orders a result, the entry orders it the same way (with a key as
tie-break); the operators themselves return unordered frames.
Parameters the reference hard-codes for its own data (thresholds, a country,
a search term) are re-chosen for the driver tables and kept here, together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import ordered as O
from ledgerlens.operators import retail as R
from ledgerlens.operators import sales as S
from ledgerlens.operators import text as X
from ledgerlens.functions import text as T
from ledgerlens.functions.cleaning import money
from ledgerlens.plans import bindings as B
from ledgerlens.session import checkpoint_dir, own_path
from ledgerlens.sources import read_csv, read_documents, read_lines, read_table, register_view, sinks

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Parameters bound to the driver tables (the reference's own values - a
# country, a category, KRW thresholds, a search term - fit only its sample data).
COUNTRY = "NATION_7"
CATEGORY = "PROMO"
VALUE_BANDS = ((40000, "High value"), (10000, "Medium value"))
VALUE_BAND_OTHER = "Low value"
HIGH_VALUE_TOTAL = 20000
HIGH_VALUE_QTY = 10
BULK_QTY = 48
MIN_PRODUCTS = 10
TERM = "the"


def query(name: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn
    return register


# --------------------------------------------------------------------------
# customers by country (the first notebook)
# --------------------------------------------------------------------------

def _customers_with_country(spark, d):
    cust = B.table(spark, d, "customer")
    nation = B.table(spark, d, "nation")
    return cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal", F.col("n_name").alias("country"))


@query("customers_in_country")
def q_customers_in_country(spark, d):
    return _customers_with_country(spark, d).filter(F.col("country") == COUNTRY)


@query("customers_in_country_count")
def q_customers_in_country_count(spark, d):
    return q_customers_in_country(spark, d).groupBy("country").count()


# --------------------------------------------------------------------------
# orders notebook (SALES)
# --------------------------------------------------------------------------

@query("category_summary")
def q_category_summary(spark, d):
    out = S.category_summary(B.sales(spark, d, ["category", "quantity", "sales_amount"]))
    return out.orderBy(F.col("total_sales_krw").desc(), "category")


@query("segment_channel")
def q_segment_channel(spark, d):
    out = S.segment_channel(B.sales(spark, d, ["customer_segment", "channel", "sales_amount"]))
    return out.orderBy("customer_segment", F.col("revenue_krw").desc(), "channel")


@query("monthly_trend")
def q_monthly_trend(spark, d):
    return S.monthly_trend(B.sales(spark, d, ["order_date", "sales_amount"])).orderBy("order_month")


@query("sales_typed")
def q_sales_typed(spark, d):
    from ledgerlens.operators.cleaning import typed_orders
    return typed_orders(B.sales_as_text(spark, d))


@query("sales_preview")
def q_sales_preview(spark, d):
    s = B.sales(spark, d)
    return S.top_n(s, [], 10, [F.col(c) for c in B.LINE_KEY]).select(
        *[F.col(c) for c in B.SALES_COLUMNS if c not in ("sales_amount", "unit_price", "discount_rate")],
        F.col("unit_price").cast("double").alias("unit_price"),
        F.col("discount_rate").cast("double").alias("discount_rate"),
        F.col("sales_amount").cast("double").alias("sales_amount"),
    )


@query("category_unreturned_top")
def q_category_unreturned_top(spark, d):
    s = B.sales(spark, d, ["order_date", "city", "product_name", "category", "quantity",
                           "sales_amount", "returned"])
    return S.filtered_top(s, CATEGORY, "No", 10)


@query("value_bands")
def q_value_bands(spark, d):
    s = B.sales(spark, d, ["product_name", "sales_amount"])
    return S.value_bands(s, VALUE_BANDS, VALUE_BAND_OTHER, 15)


@query("value_band_counts")
def q_value_band_counts(spark, d):
    return S.band_counts(B.sales(spark, d, ["sales_amount"]), VALUE_BANDS, VALUE_BAND_OTHER)


@query("missing_ratings")
def q_missing_ratings(spark, d):
    return S.missing_counts(B.sales(spark, d, ["rating"]), ["rating"])


@query("rating_filled")
def q_rating_filled(spark, d):
    return S.null_filled(B.sales(spark, d, ["product_name", "rating"]), "rating", 0, 10)


def customer_dim(spark, d) -> DataFrame:
    """customers(customer_id, home_city, segment_from_dim)."""
    return _customers_with_country(spark, d).select(
        F.col("c_custkey").alias("customer_id"), F.col("country").alias("home_city"),
        F.col("c_mktsegment").alias("segment_from_dim"))


def product_dim(spark, d) -> DataFrame:
    """products(product_id, product_name_dim, category_from_dim, unit_price)."""
    return B.table(spark, d, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name_dim"),
        F.col("p_type").alias("category_from_dim"), money("p_retailprice", 2).alias("unit_price"))


def _star_sides(spark, d) -> tuple[DataFrame, DataFrame]:
    """Lines, and orders with their customers, of the star join."""
    orders = B.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
        F.col("o_custkey").alias("customer_id"))
    return B.sales(spark, d, ["product_id", "quantity", "discount_rate"]), orders.join(customer_dim(spark, d), "customer_id")


def _star(spark, d, fact, orders) -> DataFrame:
    out = S.star_join(fact, [(orders, "order_id"), (product_dim(spark, d), "product_id")])
    amount = F.col("quantity") * F.col("unit_price") * (F.lit(1) - F.col("discount_rate"))
    return S.star_preview(out.withColumn("sales_amount", amount.cast("decimal(18,4)")), 20)


@query("star_join")
def q_star_join(spark, d):
    # the customer joins the orders and the price comes with the product: the fact is
    # shuffled once by order and once by product
    return _star(spark, d, *_star_sides(spark, d))


@query("star_join_stored")
def q_star_join_stored(spark, d):
    # both sides are stored by order, so the fact is shuffled by product only
    return _star(spark, d, *sinks.co_partitioned(list(_star_sides(spark, d)), ["order_id"], "star"))


@query("category_share")
def q_category_share(spark, d):
    s = B.sales(spark, d, ["category", "sales_amount", "returned"]).filter(F.col("returned") == "No")
    return S.share_of_total(s, "category", "sales_amount").orderBy(F.col("revenue_krw").desc(), "category")


@query("rank_in_category")
def q_rank_in_category(spark, d):
    out = S.rank_in_category(B.sales(spark, d, ["category", "product_name", "sales_amount"]), 3)
    return out.orderBy("category", "rank_within_category", "order_id")


@query("category_revenue")
def q_category_revenue(spark, d):
    s = B.sales(spark, d, ["category", "sales_amount", "returned"])
    summary = S.revenue_by(s, "category", F.col("returned") == "No")
    name = "category_revenue_summary"
    sinks.write_version(summary, name, f"{checkpoint_dir(spark)}/tables/{spark.conf.get('spark.app.id', 'app')}/{name}")
    return read_table(spark, name).orderBy(F.col("revenue_krw").desc())


@query("top_cities")
def q_top_cities(spark, d):
    return S.top_by_revenue(B.sales(spark, d, ["city", "sales_amount"]), "city", 5)


@query("return_rate")
def q_return_rate(spark, d):
    s = B.sales(spark, d, ["category", "returned"])
    return S.rate_by(s, "category", F.col("returned") == "Yes").orderBy(
        F.col("return_rate_percent").desc(), "category")


# --------------------------------------------------------------------------
# online-retail notebook (RETAIL)
# --------------------------------------------------------------------------

def retail_lines(spark, d, cols=None) -> DataFrame:
    """Cleaned retail lines (lazy), joining only the dimensions that ``cols`` need."""
    return R.clean_lines(B.retail_raw(spark, d, cols), B.HOME_COUNTRY)


PRODUCT_COLS = ["StockCode", "Description", "Quantity", "UnitPrice"]
SPEND_COLS = ["Country", "Quantity", "UnitPrice"]


@query("retail_clean")
def q_retail_clean(spark, d):
    return R.as_reported(retail_lines(spark, d))


@query("high_value_lines")
def q_high_value_lines(spark, d):
    return R.as_reported(R.high_value(retail_lines(spark, d), HIGH_VALUE_TOTAL, HIGH_VALUE_QTY))


@query("high_value_top")
def q_high_value_top(spark, d):
    return R.high_value_top(retail_lines(spark, d), HIGH_VALUE_TOTAL, HIGH_VALUE_QTY, 50)


@query("product_stats")
def q_product_stats(spark, d):
    return R.product_stats(retail_lines(spark, d, PRODUCT_COLS)).orderBy(
        F.col("total_quantity").desc(), "StockCode", "Description")


@query("product_stats_top")
def q_product_stats_top(spark, d):
    return R.product_stats_top(retail_lines(spark, d, PRODUCT_COLS), 20)


@query("customer_country_distinct")
def q_customer_country_distinct(spark, d):
    return R.distinct_customers(retail_lines(spark, d, ["Country"]))


@query("customer_country_top")
def q_customer_country_top(spark, d):
    return R.distinct_customers(retail_lines(spark, d, ["Country"])).orderBy("CustomerID", "Country").limit(50)


@query("customer_transactions")
def q_customer_transactions(spark, d):
    # the customer list needs two columns, so its side reads no part table and little else
    customers = R.distinct_customers(retail_lines(spark, d, ["CustomerID", "Country"]))
    return R.as_reported(R.customer_transactions(retail_lines(spark, d), customers))


@query("customer_transactions_preview")
def q_customer_transactions_preview(spark, d):
    return R.transactions_preview(retail_lines(spark, d), 50)


@query("customer_summary")
def q_customer_summary(spark, d):
    return R.customer_summary_fanned(retail_lines(spark, d, SPEND_COLS)).orderBy(
        F.col("total_spent").desc(), "CustomerID", "Country")


@query("customer_summary_top")
def q_customer_summary_top(spark, d):
    return R.customer_summary_top(retail_lines(spark, d, SPEND_COLS), 20)


@query("bulk_orders")
def q_bulk_orders(spark, d):
    return R.bulk_orders(retail_lines(spark, d, PRODUCT_COLS), BULK_QTY)


@query("country_summary")
def q_country_summary(spark, d):
    return R.country_summary_self(retail_lines(spark, d, SPEND_COLS)).orderBy(F.col("total_revenue").desc(), "Country")


@query("country_summary_top10")
def q_country_summary_top10(spark, d):
    return R.country_summary_self(retail_lines(spark, d, SPEND_COLS)).orderBy(
        F.col("total_revenue").desc(), "Country").limit(10)


@query("country_summary_direct")
def q_country_summary_direct(spark, d):
    return R.country_summary(retail_lines(spark, d, SPEND_COLS)).orderBy(F.col("total_revenue").desc(), "Country")


@query("customer_patterns")
def q_customer_patterns(spark, d):
    return R.customer_patterns(retail_lines(spark, d, ["StockCode", "Quantity"]), MIN_PRODUCTS).orderBy(
        F.col("unique_products").desc(), "CustomerID")


@query("monthly_revenue")
def q_monthly_revenue(spark, d):
    return R.monthly_revenue(retail_lines(spark, d, ["InvoiceDate", "Quantity", "UnitPrice"])).orderBy("year", "month")


@query("retail_loaded")
def q_retail_loaded(spark, d):
    return R.load_lines(B.retail_text(spark, d))


# --------------------------------------------------------------------------
# text notebooks and the web app's text endpoints (documents)
# --------------------------------------------------------------------------

def _docs(spark, d):
    return B.documents(spark, d)


@query("sentences_dot")
def q_sentences_dot(spark, d):
    return X.sentences(_docs(spark, d), "dot")


@query("sentence_count")
def q_sentence_count(spark, d):
    return X.sentences(_docs(spark, d), "dot").agg(F.count(F.lit(1)).alias("sentence_count"))


@query("sentences_containing")
def q_sentences_containing(spark, d):
    return X.containing(X.sentences(_docs(spark, d), "dot"), TERM)


@query("sentences_upper")
def q_sentences_upper(spark, d):
    return X.sentences(_docs(spark, d), "dot").select(
        "doc_id", "pos", F.upper("sentence").alias("uppercase_sentence"))


@query("sentences_total_length")
def q_sentences_total_length(spark, d):
    return X.sentences(_docs(spark, d), "dot").agg(
        F.sum(F.length("sentence")).cast("bigint").alias("total_length"))


@query("word_count_ws")
def q_word_count_ws(spark, d):
    words = _docs(spark, d).select("doc_id", T.dot_sentence_words(F.col("text")).alias("words"))
    return X.ranked(X.word_counts(words, "Word", "Count"), ["Word"], "Count")


@query("line_count")
def q_line_count(spark, d):
    return X.lines(_docs(spark, d)).agg(F.count(F.lit(1)).alias("total_lines"))


@query("corpus_stats")
def q_corpus_stats(spark, d):
    return X.corpus_stats(_docs(spark, d))


@query("corpus_totals")
def q_corpus_totals(spark, d):
    return X.corpus_totals(_docs(spark, d))


@query("word_freq")
def q_word_freq(spark, d):
    return X.ranked(X.word_counts(X.tokens(_docs(spark, d), "strip")), ["word"])


@query("token_totals")
def q_token_totals(spark, d):
    return X.token_totals(X.tokens(_docs(spark, d), "strip"))


@query("sentence_stats")
def q_sentence_stats(spark, d):
    return X.sentence_stats(_docs(spark, d))


@query("first_sentences")
def q_first_sentences(spark, d):
    return X.first_sentences(_docs(spark, d), 3, "punct")


def _kept_alpha(spark, d):
    lowered = X.tokens(_docs(spark, d), "alpha", lower=True)
    return X.remove_stopwords(lowered, T.NOTEBOOK_STOPWORDS, 2)


@query("top_words")
def q_top_words(spark, d):
    return X.top_counts(X.word_counts(_kept_alpha(spark, d)), 20, ["word"])


@query("kept_vs_raw")
def q_kept_vs_raw(spark, d):
    return X.kept_vs_raw(X.tokens(_docs(spark, d), "alpha", lower=True), T.NOTEBOOK_STOPWORDS, 2)


@query("top_bigrams")
def q_top_bigrams(spark, d):
    top = X.top_counts(X.bigram_counts(_kept_alpha(spark, d)), 15, ["w1", "w2"])
    return top.select("w1", "w2", F.concat_ws(" ", "w1", "w2").alias("bigram"), "count")


@query("word_length_hist")
def q_word_length_hist(spark, d):
    return X.length_histogram(X.tokens(_docs(spark, d), "alpha", lower=True)).orderBy("length")


@query("longest_words")
def q_longest_words(spark, d):
    return X.longest_words(X.tokens(_docs(spark, d), "alpha", lower=True), 15)


def _web_kept(spark, d):
    raw = X.tokens(_docs(spark, d), "strip", unicode=True)
    return X.remove_stopwords(raw, T.WEB_STOPWORDS, 2)


@query("web_text_stats")
def q_web_text_stats(spark, d):
    return X.web_text_stats(_docs(spark, d), TERM)


@query("web_top_words")
def q_web_top_words(spark, d):
    return X.top_counts(X.word_counts(_web_kept(spark, d)), 30, ["word"])


@query("web_top_bigrams")
def q_web_top_bigrams(spark, d):
    top = X.top_counts(X.bigram_counts(_web_kept(spark, d)), 15, ["w1", "w2"])
    return top.select(F.concat_ws(" ", "w1", "w2").alias("phrase"), "count")


@query("web_word_length_hist")
def q_web_word_length_hist(spark, d):
    return X.length_histogram(_web_kept(spark, d), below=15).orderBy("length")


@query("web_word_export")
def q_web_word_export(spark, d):
    return X.ranked(X.word_counts(_web_kept(spark, d)), ["word"])


# --------------------------------------------------------------------------
# lenient loading, date parts, catalogue, preview, chart data, explicit schema
# --------------------------------------------------------------------------

@query("clean_orders_lenient")
def q_clean_orders_lenient(spark, d):
    from ledgerlens.operators.cleaning import lenient_orders
    return lenient_orders(B.messy_sales_text(spark, d))


def order_date_text(spark, d) -> DataFrame:
    """Order dates as hand-kept text: pending orders say 'not a date', orders of
    unspecified priority have an empty cell."""
    o = B.table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.lit("not a date"))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date_text"),
    )


@query("lenient_date_parts")
def q_lenient_date_parts(spark, d):
    from ledgerlens.operators.cleaning import lenient_date_parts
    return lenient_date_parts(order_date_text(spark, d), "date_text")


# A data set the web catalogue lists but the driver does not ship.
MISSING_DATASET = "online_retail"


def dataset_catalog_of(spark, d) -> DataFrame:
    """The web catalogue over the driver tables (its sizes are not visible to SQL)."""
    from ledgerlens.operators.catalog import dataset_catalog
    sets = {t: f"{d.rstrip('/')}/{t}.parquet" for t in B.TABLES}
    sets[MISSING_DATASET] = f"{d.rstrip('/')}/{MISSING_DATASET}.parquet"
    return dataset_catalog(spark, sets)


@query("dataset_row_counts")
def q_dataset_row_counts(spark, d):
    cat = dataset_catalog_of(spark, d)
    return cat.select("name", "row_count", F.size("columns").cast("bigint").alias("column_count"),
                      F.array_join("columns", ",").alias("column_list"), "status")


@query("category_counts_view")
def q_category_counts_view(spark, d):
    register_view(B.sales(spark, d, ["category", "quantity"]), "orders_by_line")
    found = spark.sql(
        "SELECT category, COUNT(*) AS orders, SUM(quantity) AS units FROM orders_by_line "
        "WHERE quantity > 10 GROUP BY category")
    spark.catalog.dropTempView("orders_by_line")  # the query is resolved; nothing stays in the session
    return found


def csv_round_trip(spark, ranked: DataFrame, name: str, header: bool) -> DataFrame:
    """A ranked list written as CSV to the shared folder and read back."""
    path = own_path(spark, "exports", name)
    sinks.write_csv(ranked, path, header=header)
    return read_csv(spark, path, schema=ranked.schema, header=header)


@query("word_freq_csv")
def q_word_freq_csv(spark, d):
    return csv_round_trip(spark, q_word_freq(spark, d), "word_freq", header=True)


@query("web_word_export_csv")
def q_web_word_export_csv(spark, d):
    # the exported list with its header line, in rank order over all parts
    path = own_path(spark, "exports", "web_words")
    sinks.write_ranked_csv(X.word_counts(_web_kept(spark, d)), path, [("count", False), ("word", True)])
    return O.read_ranked_csv(spark, path, "word string, count long")


@query("word_freq_lines")
def q_word_freq_lines(spark, d):
    # the corpus as a text file: one line per row, read back line by line
    return X.ranked(X.word_counts(X.tokens(read_lines(spark, corpus_file(spark, d)), "strip", text_col="line")), ["word"])


def corpus_file(spark, d) -> str:
    """The lines of all documents, by ascending id, as text files that follow one another."""
    path = own_path(spark, "exports", "lines")
    docs = _docs(spark, d).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    X.explode_values(docs, T.lines_of(F.col("text")), "line").write.text(path)
    return path


def _corpus_lines(spark, d, words: Column | None = None) -> DataFrame:
    return O.placed_lines(spark, corpus_file(spark, d), words)


@query("lines_numbered")
def q_lines_numbered(spark, d):
    return O.numbered_lines(_corpus_lines(spark, d), whole=True).select("line_no", "line")


@query("lines_top_bigrams")
def q_lines_top_bigrams(spark, d):
    # pairs of kept words over the whole text, across lines and files
    words = T.without_stopwords(T.alpha_words(F.col("line"), lower=True), T.NOTEBOOK_STOPWORDS, 2)
    counts = O.bigram_counts(_corpus_lines(spark, d, words), whole=True)
    top = X.top_counts(counts, 15, ["w1", "w2"])
    return top.select("w1", "w2", F.concat_ws(" ", "w1", "w2").alias("bigram"), "count")


@query("lines_sentence_stats")
def q_lines_sentence_stats(spark, d):
    return O.sentence_stats_of_lines(_corpus_lines(spark, d), whole=True)


@query("lines_sentences")
def q_lines_sentences(spark, d):
    return O.sentences_of_lines(_corpus_lines(spark, d), whole=True).select("n", "sentence")


@query("lines_first_sentences")
def q_lines_first_sentences(spark, d):
    return O.sentences_of_lines(_corpus_lines(spark, d), whole=True, first=3).select("n", "sentence")


@query("word_ranks")
def q_word_ranks(spark, d):
    counts = X.word_counts(X.tokens(_docs(spark, d), "strip"))
    return O.numbered(counts, [F.col("count").desc(), F.col("word").asc()])


@query("top_words_sketched")
def q_top_words_sketched(spark, d):
    return X.top_counts_sketched(_kept_alpha(spark, d), 20)


@query("country_customers_bitmap")
def q_country_customers_bitmap(spark, d):
    lines = retail_lines(spark, d, ["Country"])
    return R.distinct_by_bitmap(lines, "Country", "CustomerID", "customers").orderBy(F.col("customers").desc(), "Country")


@query("messy_type_profile")
def q_messy_type_profile(spark, d):
    from ledgerlens.operators.cleaning import type_profile
    return type_profile(B.messy_sales_text(spark, d), ["order_date", "quantity", "unit_price", "discount_rate", "sales_amount", "rating", "returned"])


@query("customers_latin1_csv")
def q_customers_latin1_csv(spark, d):
    # a CSV in ISO-8859-1 with quotes, separators and NULL as text (S3, K6)
    label = F.concat(F.lit('Señor "'), "c_name", F.lit('", '), "country")
    rows = _customers_with_country(spark, d).select("c_custkey", label.alias("label"), F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    path = own_path(spark, "exports", "customers")
    sinks.write_csv(rows, path, null_value="NULL", encoding="ISO-8859-1")
    return read_csv(spark, path, schema=rows.schema, encoding="ISO-8859-1", null_value="NULL")


@query("whole_file_lines")
def q_whole_file_lines(spark, d):
    # every part of the corpus file as one document
    return X.lines(read_documents(spark, corpus_file(spark, d))).agg(F.count(F.lit(1)).alias("total_lines"))


@query("table_if_absent")
def q_table_if_absent(spark, d):
    # CREATE TABLE IF NOT EXISTS: the second write leaves the table as it is (K4)
    base = own_path(spark, "tables", "absent")
    name = base.rsplit("/", 1)[-1].replace("-", "_")
    cust = _customers_with_country(spark, d)
    counts = cust.groupBy("country").agg(F.count(F.lit(1)).alias("customers"))
    for rows in (counts, counts.withColumn("customers", F.col("customers") * 2)):
        sinks.write_version(rows, name, base, mode="ignore")
    return read_table(spark, name)


@query("preview_with_count")
def q_preview_with_count(spark, d):
    orders = B.table(spark, d, "orders")
    return sinks.preview_with_total(orders, [F.col("o_orderkey").asc()], 1000)


@query("preview_one_pass")
def q_preview_one_pass(spark, d):
    return sinks.preview_once(B.table(spark, d, "orders"), [F.col("o_orderkey").asc()], 1000)


@query("chart_series")
def q_chart_series(spark, d):
    return sinks.chart_series(q_category_summary(spark, d), "category", "total_sales_krw")


# Field names and types of the reference's explicit people schema.
PEOPLE_SCHEMA_FIELDS = (
    ("customerID", "int"), ("first_name", "string"), ("last_name", "string"),
    ("email_address", "string"), ("phone_number", "string"), ("address", "string"),
    ("city", "string"), ("state", "string"), ("zip_code", "string"), ("country", "string"),
    ("gender", "string"), ("birth_date", "string"),
)


def people_schema():
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    types = {"int": IntegerType(), "string": StringType()}
    return StructType([StructField(n, types[t], True) for n, t in PEOPLE_SCHEMA_FIELDS])


@query("people_from_customers")
def q_people_from_customers(spark, d):
    from ledgerlens.sources import conform
    cust = _customers_with_country(spark, d).select(
        F.col("c_custkey").alias("customerID"), F.col("c_name").alias("first_name"),
        F.col("country"))
    for name, _ in PEOPLE_SCHEMA_FIELDS:
        if name not in cust.columns:
            cust = cust.withColumn(name, F.lit(None).cast("string"))
    return conform(cust, people_schema())


@query("web_term_sentences")
def q_web_term_sentences(spark, d):
    return X.first_sentences(_docs(spark, d), 10, "punct_raw", term=TERM)


@query("web_upper_sentences")
def q_web_upper_sentences(spark, d):
    first = X.first_sentences(_docs(spark, d), 10, "punct_raw")
    return first.select("doc_id", "n", F.upper("sentence").alias("uppercase_sentence"))
