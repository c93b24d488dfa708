"""DuckDB SQL for every catalogue query (the correctness oracle).

Written independently of the Spark code: the bindings are restated once as
SQL CTEs and each query is plain SQL over the driver's views.  Exactness rules
shared with the Spark side: money is DECIMAL and cast to DOUBLE at the end;
rounded means and percentages are computed with integer arithmetic (DuckDB
divides decimals in floating point); integer results are BIGINT.
"""

from __future__ import annotations

SALES_CTE = """
sales AS (
  SELECT
    l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS product_id,
    l.l_suppkey AS supplier_id, l.l_extendedprice AS ext_price, l.l_shipdate AS ship_date,
    o.o_orderdate AS order_date, o.o_custkey AS customer_id, n.n_name AS city,
    c.c_mktsegment AS customer_segment, p.p_name AS product_name, p.p_type AS category,
    CAST(l.l_quantity AS INTEGER) AS quantity,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS unit_price,
    CAST(l.l_discount AS DECIMAL(4,2)) AS discount_rate,
    CAST(CAST(l.l_quantity AS INTEGER) * CAST(p.p_retailprice AS DECIMAL(18,2))
         * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS sales_amount,
    o.o_orderpriority AS channel, l.l_linestatus AS payment_method,
    CASE WHEN l.l_returnflag = 'R' THEN 'Yes' ELSE 'No' END AS returned,
    l.l_returnflag AS return_flag,
    CASE WHEN p.p_size <= 15 THEN 3 WHEN p.p_size <= 30 THEN 4 WHEN p.p_size <= 40 THEN 5 END AS rating
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

LINE_ORDER = "order_id, line_number, product_id, supplier_id, ext_price, ship_date"


def round_ratio(num: str, den: str, out_scale: int) -> str:
    """Exact half-up ``round(num / den, out_scale)`` as DOUBLE.

    ``num`` and ``den`` are integer-valued SQL expressions (``den > 0``,
    ``num >= 0``); the quotient is formed in HUGEINT arithmetic.
    """
    n = f"CAST({num} AS HUGEINT)"
    m = f"CAST({den} AS HUGEINT)"
    return f"(CAST((2 * {n} * {10 ** out_scale} + {m}) // (2 * {m}) AS DOUBLE) / {10 ** out_scale})"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


ORACLES: dict[str, str] = {}

# -- customers by country ---------------------------------------------------

ORACLES["customers_in_country"] = """
SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_acctbal, n.n_name AS country
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name = 'NATION_7'
"""

ORACLES["customers_in_country_count"] = """
SELECT n.n_name AS country, COUNT(*) AS count
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE n.n_name = 'NATION_7'
GROUP BY n.n_name
"""

# -- orders notebook ---------------------------------------------------------

ORACLES["category_summary"] = _with(SALES_CTE) + f"""
SELECT category,
       COUNT(*) AS number_of_orders,
       CAST(SUM(quantity) AS BIGINT) AS total_units,
       CAST(ROUND(SUM(sales_amount), 0) AS DOUBLE) AS total_sales_krw,
       {round_ratio('SUM(sales_amount) * 10000', 'COUNT(sales_amount) * 10000', 0)} AS avg_order_value_krw
FROM sales GROUP BY category
"""

ORACLES["segment_channel"] = _with(SALES_CTE) + """
SELECT customer_segment, channel, COUNT(*) AS orders,
       CAST(ROUND(SUM(sales_amount), 0) AS DOUBLE) AS revenue_krw
FROM sales GROUP BY customer_segment, channel
"""

ORACLES["monthly_trend"] = _with(SALES_CTE) + """
SELECT CAST(DATE_TRUNC('month', CAST(order_date AS TIMESTAMP)) AS TIMESTAMP) AS order_month,
       COUNT(*) AS orders,
       CAST(ROUND(SUM(sales_amount), 0) AS DOUBLE) AS monthly_revenue_krw
FROM sales GROUP BY 1
"""

ORACLES["sales_typed"] = _with(SALES_CTE) + """
SELECT order_id, line_number, product_id, supplier_id, ext_price, ship_date,
       CAST(order_date AS DATE) AS order_date, CAST(customer_id AS VARCHAR) AS customer_id, city, customer_segment,
       product_name, category, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_rate AS DOUBLE) AS discount_rate,
       CAST(sales_amount AS DOUBLE) AS sales_amount, channel, payment_method, returned, rating
FROM sales
"""

ORACLES["sales_preview"] = _with(SALES_CTE) + f"""
SELECT order_id, line_number, product_id, supplier_id, ext_price, ship_date, order_date,
       customer_id, city, customer_segment, product_name, category, quantity, channel,
       payment_method, returned, return_flag, rating,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount_rate AS DOUBLE) AS discount_rate,
       CAST(sales_amount AS DOUBLE) AS sales_amount
FROM sales ORDER BY {LINE_ORDER} LIMIT 10
"""

ORACLES["category_unreturned_top"] = _with(SALES_CTE) + f"""
SELECT order_id, order_date, city, product_name, category, quantity,
       CAST(sales_amount AS DOUBLE) AS sales_amount_krw
FROM sales WHERE category = 'PROMO' AND returned = 'No'
ORDER BY sales_amount DESC, {LINE_ORDER} LIMIT 10
"""

_BAND = """CASE WHEN sales_amount >= 40000 THEN 'High value'
            WHEN sales_amount >= 10000 THEN 'Medium value'
            ELSE 'Low value' END"""

ORACLES["value_bands"] = _with(SALES_CTE) + f"""
SELECT order_id, product_name, CAST(sales_amount AS DOUBLE) AS sales_amount_krw,
       {_BAND} AS order_value_group
FROM sales ORDER BY sales_amount DESC, {LINE_ORDER} LIMIT 15
"""

ORACLES["value_band_counts"] = _with(SALES_CTE) + f"""
SELECT {_BAND} AS order_value_group, COUNT(*) AS orders FROM sales GROUP BY 1
"""

ORACLES["missing_ratings"] = _with(SALES_CTE) + """
SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE rating IS NULL) AS missing_ratings FROM sales
"""

ORACLES["rating_filled"] = _with(SALES_CTE) + f"""
SELECT order_id, product_name, rating, COALESCE(rating, 0) AS rating_filled_with_zero
FROM sales WHERE rating IS NULL ORDER BY {LINE_ORDER} LIMIT 10
"""

ORACLES["star_join"] = _with(SALES_CTE) + f"""
SELECT s.order_id, s.order_date, n.n_name AS home_city, c.c_mktsegment AS segment_from_dim,
       p.p_name AS product_name_dim, p.p_type AS category_from_dim, s.quantity,
       CAST(s.sales_amount AS DOUBLE) AS sales_amount_krw
FROM sales s
JOIN customer c ON s.customer_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON s.product_id = p.p_partkey
ORDER BY s.order_date, s.order_id, s.line_number, s.product_id, s.supplier_id, s.ext_price, s.ship_date
LIMIT 20
"""

ORACLES["category_share"] = _with(SALES_CTE, """
category_sales AS (
  SELECT category, SUM(sales_amount) AS revenue FROM sales WHERE returned = 'No' GROUP BY category
)""", """
total_sales AS (SELECT SUM(revenue) AS total FROM category_sales)
""") + f"""
SELECT category, CAST(ROUND(revenue, 0) AS DOUBLE) AS revenue_krw,
       {round_ratio('100 * revenue * 10000', 'total * 10000', 2)} AS revenue_share_percent
FROM category_sales CROSS JOIN total_sales
"""

ORACLES["rank_in_category"] = _with(SALES_CTE) + """
SELECT * FROM (
  SELECT order_id, category, product_name, CAST(sales_amount AS DOUBLE) AS sales_amount_krw,
         RANK() OVER (PARTITION BY category ORDER BY sales_amount DESC) AS rank_within_category
  FROM sales
) WHERE rank_within_category <= 3
"""

ORACLES["category_revenue"] = _with(SALES_CTE) + """
SELECT category, CAST(SUM(sales_amount) AS DOUBLE) AS revenue_krw
FROM sales WHERE returned = 'No' GROUP BY category
"""

ORACLES["top_cities"] = _with(SALES_CTE) + """
SELECT city, CAST(ROUND(SUM(sales_amount), 0) AS DOUBLE) AS revenue_krw
FROM sales GROUP BY city ORDER BY revenue_krw DESC, city LIMIT 5
"""

ORACLES["return_rate"] = _with(SALES_CTE) + f"""
SELECT category, COUNT(*) AS total_orders,
       COUNT(*) FILTER (WHERE returned = 'Yes') AS returned_orders,
       {round_ratio("100 * COUNT(*) FILTER (WHERE returned = 'Yes')", 'COUNT(*)', 2)} AS return_rate_percent
FROM sales GROUP BY category
"""

# -- online-retail notebook --------------------------------------------------

RETAIL_CTE = r"""
retail_raw AS (
  SELECT
    l.l_orderkey AS InvoiceNo, l.l_partkey AS StockCode, p.p_name AS Description,
    CAST(l.l_quantity AS INTEGER) AS Quantity,
    strftime(o.o_orderdate, '%-d/%-m/%Y %-H:%M') AS InvoiceDate,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS UnitPrice,
    CASE WHEN c.c_acctbal >= 0 THEN o.o_custkey END AS CustomerID,
    n.n_name AS Country,
    l.l_linenumber AS LineNo, l.l_suppkey AS SupplierNo, l.l_extendedprice AS LineAmount,
    l.l_shipdate AS ShipDate, l.l_returnflag AS return_flag
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
retail AS (
  SELECT InvoiceNo, StockCode, Description, Quantity,
    try_strptime(regexp_replace(InvoiceDate, '^(\d+)/(\d+)/', '\2/\1/'), '%m/%d/%Y %H:%M') AS InvoiceDate,
    UnitPrice, CustomerID, Country, Quantity * UnitPrice AS TotalPrice,
    CASE WHEN Country = 'NATION_0' THEN 1 ELSE 0 END AS IsUK,
    LineNo, SupplierNo, LineAmount, ShipDate
  FROM retail_raw WHERE CustomerID IS NOT NULL
)"""

RETAIL_ORDER = "InvoiceNo, LineNo, StockCode, SupplierNo, LineAmount, ShipDate"
RETAIL_OUT = """InvoiceNo, StockCode, Description, Quantity, InvoiceDate,
  CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country,
  CAST(TotalPrice AS DOUBLE) AS TotalPrice, IsUK"""

ORACLES["retail_clean"] = _with(RETAIL_CTE) + f"SELECT {RETAIL_OUT} FROM retail"

ORACLES["high_value_lines"] = _with(RETAIL_CTE) + f"""
SELECT {RETAIL_OUT} FROM retail WHERE TotalPrice > 20000 AND Quantity > 10
"""

ORACLES["high_value_top"] = _with(RETAIL_CTE) + f"""
SELECT InvoiceNo, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice,
       CAST(ROUND(TotalPrice, 2) AS DOUBLE) AS TotalPrice, CustomerID, Country
FROM retail WHERE TotalPrice > 20000 AND Quantity > 10
ORDER BY retail.TotalPrice DESC, {RETAIL_ORDER} LIMIT 50
"""

ORACLES["product_stats"] = _with(RETAIL_CTE) + """
SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS total_quantity,
       CAST(SUM(TotalPrice) AS DOUBLE) / COUNT(TotalPrice) AS avg_price,
       COUNT(InvoiceNo) AS transaction_count
FROM retail GROUP BY StockCode, Description
"""

ORACLES["product_stats_top"] = _with(RETAIL_CTE) + f"""
SELECT StockCode, Description, CAST(SUM(Quantity) AS BIGINT) AS total_quantity,
       {round_ratio('SUM(TotalPrice) * 100', 'COUNT(TotalPrice) * 100', 2)} AS avg_price,
       COUNT(InvoiceNo) AS transaction_count
FROM retail GROUP BY StockCode, Description
ORDER BY total_quantity DESC, StockCode, Description LIMIT 20
"""

ORACLES["customer_country_distinct"] = _with(RETAIL_CTE) + """
SELECT DISTINCT CustomerID, Country FROM retail
"""

ORACLES["customer_country_top"] = _with(RETAIL_CTE) + """
SELECT DISTINCT CustomerID, Country FROM retail ORDER BY CustomerID, Country LIMIT 50
"""

ORACLES["customer_transactions"] = _with(RETAIL_CTE, """
customers AS (SELECT DISTINCT CustomerID, Country FROM retail)
""") + """
SELECT r.InvoiceNo, r.StockCode, r.Description, r.Quantity, r.InvoiceDate,
       CAST(r.UnitPrice AS DOUBLE) AS UnitPrice, r.CustomerID, r.Country,
       CAST(r.TotalPrice AS DOUBLE) AS TotalPrice, r.IsUK
FROM retail r JOIN customers c ON r.CustomerID = c.CustomerID
"""

ORACLES["customer_transactions_preview"] = _with(RETAIL_CTE) + f"""
SELECT CustomerID, InvoiceNo, StockCode, Description, Quantity,
       CAST(ROUND(UnitPrice, 2) AS DOUBLE) AS UnitPrice,
       CAST(ROUND(TotalPrice, 2) AS DOUBLE) AS TotalPrice, Country
FROM retail ORDER BY CustomerID, {RETAIL_ORDER} LIMIT 50
"""

ORACLES["customer_summary"] = _with(RETAIL_CTE, """
customers AS (SELECT DISTINCT CustomerID, Country FROM retail)
""") + """
SELECT r.CustomerID, r.Country, CAST(SUM(r.TotalPrice) AS DOUBLE) AS total_spent,
       COUNT(r.InvoiceNo) AS purchase_count
FROM retail r JOIN customers c ON r.CustomerID = c.CustomerID
GROUP BY r.CustomerID, r.Country
"""

ORACLES["customer_summary_top"] = _with(RETAIL_CTE) + """
SELECT CustomerID, Country, CAST(ROUND(SUM(TotalPrice), 2) AS DOUBLE) AS total_spent,
       COUNT(InvoiceNo) AS purchase_count
FROM retail GROUP BY CustomerID, Country
ORDER BY SUM(TotalPrice) DESC, CustomerID, Country LIMIT 20
"""

ORACLES["bulk_orders"] = _with(RETAIL_CTE) + """
SELECT CustomerID, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM retail WHERE Quantity > 48 ORDER BY Quantity DESC
"""

# literal self-join, as the reference writes it (fan-out kept, D13)
_COUNTRY_SUMMARY = """
SELECT c.Country, COUNT(DISTINCT r.InvoiceNo) AS invoice_count,
       CAST(ROUND(SUM(r.Quantity * r.UnitPrice), 2) AS DOUBLE) AS total_revenue
FROM retail r JOIN retail c ON r.CustomerID = c.CustomerID
GROUP BY c.Country
"""

ORACLES["country_summary"] = _with(RETAIL_CTE) + _COUNTRY_SUMMARY

ORACLES["country_summary_top10"] = _with(RETAIL_CTE) + f"""
SELECT * FROM ({_COUNTRY_SUMMARY}) ORDER BY total_revenue DESC, Country LIMIT 10
"""

ORACLES["country_summary_direct"] = _with(RETAIL_CTE) + """
SELECT Country, COUNT(DISTINCT InvoiceNo) AS invoice_count,
       CAST(ROUND(SUM(Quantity * UnitPrice), 2) AS DOUBLE) AS total_revenue
FROM retail GROUP BY Country
"""

ORACLES["customer_patterns"] = _with(RETAIL_CTE) + """
SELECT CustomerID, COUNT(DISTINCT StockCode) AS unique_products, AVG(Quantity) AS avg_quantity
FROM retail GROUP BY CustomerID HAVING COUNT(DISTINCT StockCode) > 10
"""

ORACLES["monthly_revenue"] = _with(RETAIL_CTE) + """
SELECT CAST(YEAR(InvoiceDate) AS BIGINT) AS year, CAST(MONTH(InvoiceDate) AS BIGINT) AS month,
       CAST(SUM(TotalPrice) AS DOUBLE) AS monthly_revenue
FROM retail GROUP BY 1, 2
"""

# -- text ---------------------------------------------------------------------

from ledgerlens.functions.text import NOTEBOOK_STOPWORDS, WEB_STOPWORDS  # noqa: E402  (fixed word lists)


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


# White space of the tokenizers of the notebooks (ASCII) and of sentences and the web app
# (Unicode: what Python's ``str.isspace`` says yes to).
_WS = r"[ \t\n\x0B\f\r]"
_UNI = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_UWS = f"[{_UNI}]"

DOC_CTE = r"""
doc_lines AS (
  SELECT doc_id, text,
    CASE WHEN text = '' THEN CAST([] AS VARCHAR[])
         ELSE string_split_regex(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') END AS lines
  FROM documents
),
doc_joined AS (SELECT doc_id, text, lines, array_to_string(lines, ' ') AS joined FROM doc_lines)"""

DOT_CTE = r"""
dot_lists AS (
  SELECT doc_id,
    list_filter(flatten(list_transform(lines, lambda l: string_split_regex(l, '\.'))),
                lambda s: trim(s) <> '') AS sentences
  FROM doc_lines
),
dot_rows AS (
  SELECT doc_id, generate_subscripts(sentences, 1) AS pos, unnest(sentences) AS sentence FROM dot_lists
)"""


def _punct(expr: str) -> str:
    marked = f"regexp_replace({expr}, '([.!?]){_UWS}+', '\\1' || chr(1), 'g')"
    stripped = f"lambda s: regexp_replace(s, '^{_UWS}+|{_UWS}+$', '', 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), {stripped}), lambda s: s <> '')"


PUNCT_CTE = f"""
punct_lists AS (SELECT doc_id, {_punct('joined')} AS sentences FROM doc_joined),
punct_rows AS (
  SELECT doc_id, generate_subscripts(sentences, 1) AS pos, unnest(sentences) AS sentence FROM punct_lists
)"""

ALPHA_CTE = """
alpha AS (SELECT doc_id, regexp_extract_all(joined, '[A-Za-z'']+') AS words FROM doc_joined),
alpha_lower AS (SELECT doc_id, list_transform(words, lambda w: lower(w)) AS words FROM alpha)"""

KEPT_CTE = f"""
kept AS (
  SELECT doc_id, list_filter(words, lambda w: NOT list_contains({_sql_list(NOTEBOOK_STOPWORDS)}, w)
                                             AND length(w) >= 2) AS words
  FROM alpha_lower
)"""

STRIP_CTE = f"""
strip AS (
  SELECT doc_id,
    list_filter(string_split_regex(lower(regexp_replace(text, '[^A-Za-z0-9_ \\t\\n\\x0B\\f\\r]', ' ', 'g')),
                                   '{_WS}+'), lambda w: length(w) > 0) AS words
  FROM documents
)"""

WEB_CTE = f"""
web_words AS (
  SELECT doc_id,
    list_filter(string_split_regex(
        regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}_{_UNI}]', ' ', 'g'),
        '{_UWS}+'), lambda w: length(w) > 0) AS words
  FROM documents
),
web_kept AS (
  SELECT doc_id, list_filter(words, lambda w: NOT list_contains({_sql_list(WEB_STOPWORDS)}, w)
                                             AND length(w) >= 2) AS words
  FROM web_words
)"""


def _bigrams(src: str) -> str:
    return f"""
{src}_rows AS (SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS w FROM {src}),
{src}_pairs AS (
  SELECT w AS w1, lead(w) OVER (PARTITION BY doc_id ORDER BY pos) AS w2 FROM {src}_rows
)"""


ORACLES["sentences_dot"] = _with(DOC_CTE, DOT_CTE) + "SELECT doc_id, pos, sentence FROM dot_rows"

ORACLES["sentence_count"] = _with(DOC_CTE, DOT_CTE) + "SELECT COUNT(*) AS sentence_count FROM dot_rows"

ORACLES["sentences_containing"] = _with(DOC_CTE, DOT_CTE) + """
SELECT doc_id, pos, sentence FROM dot_rows WHERE contains(sentence, 'the')
"""

ORACLES["sentences_upper"] = _with(DOC_CTE, DOT_CTE) + """
SELECT doc_id, pos, upper(replace(sentence, 'ß', 'ss')) AS uppercase_sentence FROM dot_rows
"""

ORACLES["sentences_total_length"] = _with(DOC_CTE, DOT_CTE) + """
SELECT CAST(SUM(length(sentence)) AS BIGINT) AS total_length FROM dot_rows
"""

ORACLES["word_count_ws"] = _with(DOC_CTE, DOT_CTE) + f"""
SELECT Word, COUNT(*) AS Count FROM (
  SELECT unnest(list_filter(string_split_regex(lower(trim(sentence)), '{_WS}+'), lambda w: w <> '')) AS Word
  FROM dot_rows
) GROUP BY Word
"""

ORACLES["line_count"] = _with(DOC_CTE) + "SELECT CAST(SUM(len(lines)) AS BIGINT) AS total_lines FROM doc_lines"

ORACLES["corpus_stats"] = _with(DOC_CTE, ALPHA_CTE) + """
SELECT d.doc_id, CAST(length(d.joined) AS BIGINT) AS characters, CAST(len(d.lines) AS BIGINT) AS lines,
       CAST(len(a.words) AS BIGINT) AS words,
       CAST(len(list_distinct(list_transform(a.words, lambda w: lower(w)))) AS BIGINT) AS unique_words,
       CAST(COALESCE(list_sum(list_transform(a.words, lambda w: length(w))), 0) AS DOUBLE)
         / CAST(greatest(len(a.words), 1) AS DOUBLE) AS avg_word_length
FROM doc_joined d JOIN alpha a ON d.doc_id = a.doc_id
"""

ORACLES["corpus_totals"] = _with(DOC_CTE, ALPHA_CTE) + """
SELECT COUNT(*) AS documents, CAST(SUM(length(d.joined)) AS BIGINT) AS characters,
       CAST(SUM(len(d.lines)) AS BIGINT) AS lines, CAST(SUM(len(a.words)) AS BIGINT) AS words,
       (SELECT COUNT(DISTINCT w) FROM (SELECT unnest(words) AS w FROM alpha_lower)) AS unique_words,
       CAST(COALESCE((SELECT SUM(length(w)) FROM (SELECT unnest(words) AS w FROM alpha_lower)), 0) AS DOUBLE)
         / CAST(greatest(SUM(len(a.words)), 1) AS DOUBLE) AS avg_word_length
FROM doc_joined d JOIN alpha a ON d.doc_id = a.doc_id
"""

ORACLES["word_freq"] = _with(STRIP_CTE) + """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM strip) GROUP BY word
"""

ORACLES["token_totals"] = _with(STRIP_CTE) + """
SELECT COUNT(*) AS total_tokens, COUNT(DISTINCT word) AS unique_words
FROM (SELECT unnest(words) AS word FROM strip)
"""

ORACLES["sentence_stats"] = _with(DOC_CTE, PUNCT_CTE) + """
SELECT COUNT(*) AS sentences,
       CAST(COALESCE(SUM(n), 0) AS DOUBLE) / CAST(greatest(COUNT(*), 1) AS DOUBLE) AS avg_words_per_sentence,
       CAST(MIN(n) AS BIGINT) AS min_words, CAST(MAX(n) AS BIGINT) AS max_words
FROM (SELECT len(regexp_extract_all(sentence, '[A-Za-z'']+')) AS n FROM punct_rows)
"""

ORACLES["first_sentences"] = _with(DOC_CTE, PUNCT_CTE) + """
SELECT doc_id, pos AS n, sentence FROM punct_rows WHERE pos <= 3
"""

ORACLES["top_words"] = _with(DOC_CTE, ALPHA_CTE, KEPT_CTE) + """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM kept)
GROUP BY word ORDER BY count DESC, word LIMIT 20
"""

ORACLES["kept_vs_raw"] = _with(DOC_CTE, ALPHA_CTE, KEPT_CTE) + """
SELECT (SELECT CAST(SUM(len(words)) AS BIGINT) FROM kept) AS kept_tokens,
       (SELECT CAST(SUM(len(words)) AS BIGINT) FROM alpha_lower) AS raw_tokens
"""

ORACLES["top_bigrams"] = _with(DOC_CTE, ALPHA_CTE, KEPT_CTE, _bigrams("kept")) + """
SELECT w1, w2, w1 || ' ' || w2 AS bigram, COUNT(*) AS count FROM kept_pairs WHERE w2 IS NOT NULL
GROUP BY w1, w2 ORDER BY count DESC, w1, w2 LIMIT 15
"""

ORACLES["word_length_hist"] = _with(DOC_CTE, ALPHA_CTE) + """
SELECT CAST(length(w) AS BIGINT) AS length, COUNT(*) AS count
FROM (SELECT unnest(words) AS w FROM alpha_lower) GROUP BY 1
"""

ORACLES["longest_words"] = _with(DOC_CTE, ALPHA_CTE) + """
SELECT word, CAST(length(word) AS BIGINT) AS length
FROM (SELECT DISTINCT unnest(words) AS word FROM alpha_lower)
ORDER BY length DESC, word LIMIT 15
"""

ORACLES["web_text_stats"] = _with(WEB_CTE, f"""
s AS (SELECT doc_id, text, {_punct('text')} AS sentences FROM documents)
""") + """
SELECT s.doc_id, CAST(length(s.text) AS BIGINT) AS total_characters,
       CAST(len(w.words) AS BIGINT) AS total_words,
       CAST(len(s.sentences) AS BIGINT) AS total_sentences,
       CAST(len(list_filter(s.sentences, lambda x: contains(x, 'the'))) AS BIGINT) AS term_sentences
FROM s JOIN web_words w ON s.doc_id = w.doc_id
"""

ORACLES["web_top_words"] = _with(WEB_CTE) + """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM web_kept)
GROUP BY word ORDER BY count DESC, word LIMIT 30
"""

ORACLES["web_top_bigrams"] = _with(WEB_CTE, _bigrams("web_kept")) + """
SELECT w1 || ' ' || w2 AS phrase, COUNT(*) AS count FROM web_kept_pairs WHERE w2 IS NOT NULL
GROUP BY w1, w2 ORDER BY count DESC, w1, w2 LIMIT 15
"""

ORACLES["web_word_length_hist"] = _with(WEB_CTE) + """
SELECT CAST(length(w) AS BIGINT) AS length, COUNT(*) AS count
FROM (SELECT unnest(words) AS w FROM web_kept) WHERE length(w) < 15 GROUP BY 1
"""

ORACLES["web_word_export"] = _with(WEB_CTE) + """
SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM web_kept) GROUP BY word
"""

# -- lenient loading, date parts, catalogue, preview, chart, schema -------------

MESSY_CTE = """
messy AS (
  SELECT order_id, line_number, product_id, supplier_id, ext_price, ship_date, category,
    CASE WHEN channel = '5-LOW' THEN 'unknown' ELSE strftime(order_date, '%Y-%m-%d') END AS order_date,
    CASE WHEN payment_method = 'O' THEN CAST(quantity AS VARCHAR) || ' pcs'
         WHEN line_number = 2 THEN CAST(quantity AS VARCHAR) || '.0'
         WHEN line_number = 3 THEN CAST(quantity AS VARCHAR) || '.7'
         WHEN line_number = 4 THEN CAST(quantity AS VARCHAR) || 'e2'
         ELSE CAST(quantity AS VARCHAR) END AS quantity,
    CASE WHEN returned = 'Yes' THEN '' ELSE CAST(unit_price AS VARCHAR) END AS unit_price,
    CASE WHEN discount_rate = 0 THEN 'none' ELSE CAST(discount_rate AS VARCHAR) END AS discount_rate,
    CAST(sales_amount AS VARCHAR) AS sales_amount,
    CASE WHEN return_flag <> 'A' THEN returned END AS returned,
    COALESCE(CAST(rating AS VARCHAR), '') AS rating
  FROM sales
)"""

ORACLES["clean_orders_lenient"] = _with(SALES_CTE, MESSY_CTE) + """
SELECT order_id, line_number, product_id, supplier_id, ext_price, ship_date, category,
  strftime(TRY_CAST(order_date AS TIMESTAMP), '%Y-%m-%d') AS order_date,
  COALESCE(TRY_CAST(trunc(TRY_CAST(quantity AS DOUBLE)) AS INTEGER), 0) AS quantity,
  COALESCE(TRY_CAST(unit_price AS DOUBLE), 0.0) AS unit_price,
  COALESCE(TRY_CAST(discount_rate AS DOUBLE), 0.0) AS discount_rate,
  COALESCE(TRY_CAST(sales_amount AS DOUBLE), 0.0) AS sales_amount,
  COALESCE(returned, 'No') AS returned,
  TRY_CAST(rating AS DOUBLE) AS rating
FROM messy
"""

ORACLES["lenient_date_parts"] = """
WITH t AS (
  SELECT o_orderkey,
    CASE WHEN o_orderstatus = 'P' THEN 'not a date'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text
  FROM orders
), p AS (SELECT o_orderkey, date_text, TRY_CAST(date_text AS TIMESTAMP) AS ts FROM t)
SELECT o_orderkey, date_text, CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month,
       CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
       CAST(date_trunc('year', ts) AS TIMESTAMP) AS year_start,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start
FROM p
"""


def _count_row(t: str, cols: str) -> str:
    return (f"SELECT '{t}' AS name, (SELECT COUNT(*) FROM {t}) AS row_count, "
            f"CAST({len(cols.split(','))} AS BIGINT) AS column_count, '{cols}' AS column_list, "
            "'Ready' AS status")


_TABLE_COLUMNS = {
    "region": "r_regionkey,r_name",
    "nation": "n_nationkey,n_name,n_regionkey",
    "customer": "c_custkey,c_name,c_nationkey,c_acctbal,c_mktsegment",
    "supplier": "s_suppkey,s_name,s_nationkey,s_acctbal",
    "part": "p_partkey,p_name,p_brand,p_type,p_size,p_retailprice",
    "orders": "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority",
    "lineitem": ("l_orderkey,l_partkey,l_suppkey,l_linenumber,l_quantity,l_extendedprice,"
                 "l_discount,l_tax,l_returnflag,l_linestatus,l_shipdate"),
    "events": "event_id,ts,user_id,event_type,value,props",
    "documents": "doc_id,text,lang,source,n_chars",
    "embeddings": "vec_id,embedding,label",
    "pages": "page_id,url,html",
    "benchmark": "item_id,text",
    "labels": "doc_id,quality,toxic",
    "conversations": "conv_id,turn,role,text",
}

ORACLES["dataset_row_counts"] = "\nUNION ALL\n".join(
    [_count_row(t, c) for t, c in _TABLE_COLUMNS.items()]
    + ["SELECT 'online_retail' AS name, CAST(0 AS BIGINT) AS row_count, CAST(0 AS BIGINT) AS column_count, "
       "'' AS column_list, 'Missing' AS status"])

ORACLES["preview_with_count"] = """
SELECT o.*, (SELECT COUNT(*) FROM orders) AS total_rows FROM orders o ORDER BY o_orderkey LIMIT 1000
"""

ORACLES["chart_series"] = _with(SALES_CTE) + """
SELECT COALESCE(CAST(category AS VARCHAR), 'NULL') AS label,
       COALESCE(TRY_CAST(CAST(ROUND(SUM(sales_amount), 0) AS DOUBLE) AS DOUBLE), 0.0) AS value
FROM sales GROUP BY category
"""

ORACLES["people_from_customers"] = """
SELECT CAST(c.c_custkey AS INTEGER) AS customerID, c.c_name AS first_name,
       CAST(NULL AS VARCHAR) AS last_name, CAST(NULL AS VARCHAR) AS email_address,
       CAST(NULL AS VARCHAR) AS phone_number, CAST(NULL AS VARCHAR) AS address,
       CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
       CAST(NULL AS VARCHAR) AS zip_code, n.n_name AS country,
       CAST(NULL AS VARCHAR) AS gender, CAST(NULL AS VARCHAR) AS birth_date
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

RAW_PUNCT_CTE = f"""
raw_lists AS (SELECT doc_id, {_punct('text')} AS sentences FROM documents),
raw_rows AS (
  SELECT doc_id, generate_subscripts(sentences, 1) AS pos, unnest(sentences) AS sentence FROM raw_lists
)"""

ORACLES["web_term_sentences"] = _with(RAW_PUNCT_CTE) + """
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS n, sentence
FROM raw_rows WHERE contains(sentence, 'the') QUALIFY n <= 10
"""

ORACLES["web_upper_sentences"] = _with(RAW_PUNCT_CTE) + """
SELECT doc_id, pos AS n, upper(replace(sentence, 'ß', 'ss')) AS uppercase_sentence
FROM raw_rows WHERE pos <= 10
"""

# -- views, text lines, CSV round trips, untyped retail lines ------------------

ORACLES["category_counts_view"] = _with(SALES_CTE) + """
SELECT category, COUNT(*) AS orders, CAST(SUM(quantity) AS BIGINT) AS units
FROM sales WHERE quantity > 10 GROUP BY category
"""

ORACLES["word_freq_csv"] = ORACLES["word_freq"]
ORACLES["word_freq_lines"] = ORACLES["word_freq"]
ORACLES["web_word_export_csv"] = _with(WEB_CTE) + """
SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank
FROM (SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM web_kept) GROUP BY word)
"""

# The lines of all documents, by ascending id, as one text.
CORPUS_CTE = """
corpus_lines AS (
  SELECT row_number() OVER (ORDER BY doc_id, pos) AS line_no, line
  FROM (SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM doc_lines)
),
corpus AS (SELECT string_agg(line, ' ' ORDER BY line_no) AS joined FROM corpus_lines)"""

CORPUS_SENTENCES_CTE = f"""
corpus_lists AS (SELECT {_punct('joined')} AS sentences FROM corpus),
corpus_rows AS (SELECT generate_subscripts(sentences, 1) AS n, unnest(sentences) AS sentence FROM corpus_lists)"""

ORACLES["lines_numbered"] = _with(DOC_CTE, CORPUS_CTE) + "SELECT line_no, line FROM corpus_lines"
ORACLES["lines_sentences"] = _with(DOC_CTE, CORPUS_CTE, CORPUS_SENTENCES_CTE) + "SELECT n, sentence FROM corpus_rows"
ORACLES["lines_first_sentences"] = ORACLES["lines_sentences"] + " WHERE n <= 3"
ORACLES["lines_sentence_stats"] = _with(DOC_CTE, CORPUS_CTE, CORPUS_SENTENCES_CTE) + """
SELECT COUNT(*) AS sentences,
       CAST(COALESCE(SUM(n), 0) AS DOUBLE) / CAST(greatest(COUNT(*), 1) AS DOUBLE) AS avg_words_per_sentence,
       CAST(MIN(n) AS BIGINT) AS min_words, CAST(MAX(n) AS BIGINT) AS max_words
FROM (SELECT len(regexp_extract_all(sentence, '[A-Za-z'']+')) AS n FROM corpus_rows)
"""
ORACLES["lines_top_bigrams"] = _with(DOC_CTE, ALPHA_CTE, KEPT_CTE) + """,
words_in_order AS (SELECT doc_id, generate_subscripts(words, 1) AS pos, unnest(words) AS w FROM kept),
pairs AS (SELECT w AS w1, lead(w) OVER (ORDER BY doc_id, pos) AS w2 FROM words_in_order)
SELECT w1, w2, w1 || ' ' || w2 AS bigram, COUNT(*) AS count FROM pairs WHERE w2 IS NOT NULL
GROUP BY w1, w2 ORDER BY count DESC, w1, w2 LIMIT 15
"""
ORACLES["word_ranks"] = _with(STRIP_CTE) + """
SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank
FROM (SELECT word, COUNT(*) AS count FROM (SELECT unnest(words) AS word FROM strip) GROUP BY word)
"""
ORACLES["top_words_sketched"] = ORACLES["top_words"]
ORACLES["star_join_stored"] = ORACLES["star_join"]
ORACLES["preview_one_pass"] = ORACLES["preview_with_count"]

ORACLES["retail_loaded"] = _with(RETAIL_CTE, """
as_text AS (
  SELECT InvoiceNo, LineNo, StockCode, SupplierNo, LineAmount, ShipDate,
    CAST(CustomerID AS VARCHAR) || '.0' AS CustomerID,
    CASE WHEN LineNo = 3 THEN '2 for 1' WHEN LineNo = 4 THEN CAST(Quantity AS VARCHAR) || 'e1'
         WHEN LineNo = 5 THEN CAST(Quantity AS VARCHAR) || '.7' ELSE CAST(Quantity AS VARCHAR) END AS Quantity,
    CASE WHEN return_flag = 'R' THEN '' ELSE CAST(UnitPrice AS VARCHAR) END AS UnitPrice
  FROM retail_raw
)""") + """
SELECT InvoiceNo, LineNo, StockCode, SupplierNo, LineAmount, ShipDate,
  CAST(trunc(TRY_CAST(CustomerID AS DOUBLE)) AS BIGINT) AS CustomerID,
  COALESCE(TRY_CAST(trunc(TRY_CAST(Quantity AS DOUBLE)) AS INTEGER), 0) AS Quantity,
  COALESCE(TRY_CAST(UnitPrice AS DOUBLE), 0.0) AS UnitPrice
FROM as_text
"""


def _profile(column: str) -> str:
    t = f"trim({column})"
    filled = f"({column} IS NOT NULL AND {t} <> '')"
    return f"""
SELECT '{column}' AS "column", count(*) FILTER ({filled}) AS filled, count(*) FILTER (NOT coalesce({filled}, false)) AS empty,
  count(*) FILTER (regexp_matches({t}, '^[+-]?[0-9]{{1,18}}$')) AS integers,
  count(*) FILTER (regexp_matches({t}, '^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]{{1,2}})?$')) AS numbers,
  count(*) FILTER (regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$') AND TRY_CAST({t} AS DATE) IS NOT NULL) AS dates
FROM messy"""


ORACLES["messy_type_profile"] = _with(SALES_CTE, MESSY_CTE, "counted AS (" + " UNION ALL ".join(
    _profile(c) for c in ("order_date", "quantity", "unit_price", "discount_rate", "sales_amount", "rating", "returned")) + ")") + """,
typed AS (
  SELECT *, CASE WHEN filled = 0 THEN 'text' WHEN integers = filled THEN 'integer' WHEN numbers = filled THEN 'number' WHEN dates = filled THEN 'date'
    WHEN 2 * numbers > filled THEN 'number' WHEN 2 * dates > filled THEN 'date' ELSE 'text' END AS type
  FROM counted
)
SELECT *, filled - CASE type WHEN 'integer' THEN integers WHEN 'number' THEN numbers WHEN 'date' THEN dates ELSE filled END AS bad FROM typed
"""

ORACLES["country_customers_bitmap"] = _with(RETAIL_CTE) + """
SELECT Country, count(DISTINCT CustomerID) AS customers FROM retail GROUP BY Country
"""

ORACLES["customers_latin1_csv"] = """
SELECT c.c_custkey, 'Señor "' || c.c_name || '", ' || n.n_name AS label, CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END AS segment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
"""
ORACLES["whole_file_lines"] = ORACLES["line_count"]
ORACLES["table_if_absent"] = """
SELECT n.n_name AS country, count(*) AS customers
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey GROUP BY 1
"""
