"""Raw work items derived from the warehouse tables in ``sf_dir``.

The pipeline's input is open-schema JSON work records. The test warehouse holds TPC-H-style
tables instead, so these builders turn warehouse rows into JSON items with Spark (one item per
order, one author per line item, ...), deterministically dirtied by key arithmetic: absent and
empty fields, blank and upper-case DOIs, duplicate DOIs across order pairs, invalid and future
dates, name-only authors, blank identifiers. The resulting ``raw_item`` text column is the same
shape as a landed raw file, so every downstream operator runs its real code path, and the work
grows with the tables.

Cost: ``order_works`` shuffles eight short columns of ``lineitem`` once on the order key (collect per
order is bounded by the lines of one order), makes the authors with the item, and joins ``orders`` on the same key, reusing that partitioning.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubspark.session import freed_shuffles

# Order-pair id: consecutive orders share one DOI, so de-duplication has real work to do.
PAIR = "CAST(floor(o_orderkey / 2) AS BIGINT)"
DOI_PREFIX = f"concat('10.', CAST(5000 + {PAIR} % 40 AS STRING))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _date_json(y: str, m: str, d: str) -> str:
    return f"concat('[[', {y}, ',', {m}, ',', {d}, ']]')"


#: Line item columns of which an author is made, the line's number first.
_AUTHOR_LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _four_digits(n: str) -> str:
    """``format_string('%04d', n)`` without the formatter, which is slow, where ``n`` is not negative."""
    return (f"CASE WHEN {n} BETWEEN 0 AND 9999 THEN lpad(CAST({n} AS STRING), 4, '0') "
            f"WHEN {n} > 9999 THEN CAST({n} AS STRING) ELSE format_string('%04d', {n}) END")


def _author_struct() -> str:
    """One author object of a line item (SQL over the line's columns)."""
    orcid = ("CASE WHEN l_partkey % 3 = 0 THEN concat(CASE WHEN l_partkey % 2 = 0 "
             "THEN 'https://orcid.org/' ELSE 'http://orcid.org/' END, "
             f"'0000-0002-', {_four_digits('l_partkey')}, '-', {_four_digits('l_suppkey')}) END")
    given = ("CASE WHEN l_tax = 0 THEN '' WHEN l_discount = 0 THEN NULL "
             "ELSE concat('Given', CAST(l_partkey % 60 AS STRING)) END")
    named = "l_returnflag = 'R' AND l_linestatus = 'F'"
    empty = "l_quantity < 3"
    return f"""named_struct(
        'given', CASE WHEN {named} OR {empty} THEN NULL ELSE {given} END,
        'family', CASE WHEN {named} OR {empty} THEN NULL
                       ELSE concat('Family', CAST(l_suppkey % 25 AS STRING)) END,
        'name', CASE WHEN {named} THEN concat('Consortium ', CAST(l_suppkey % 9 AS STRING)) END,
        'ORCID', CASE WHEN {named} OR {empty} THEN NULL ELSE {orcid} END,
        'sequence', CASE WHEN l_linenumber = 1 AND NOT ({named} OR {empty}) THEN 'first'
                         ELSE 'additional' END,
        'affiliation', CASE WHEN {named} OR {empty} THEN NULL
                            WHEN l_suppkey % 2 = 0 THEN array(named_struct('name',
                                 concat('Institute ', CAST(l_suppkey % 7 AS STRING))))
                            ELSE CAST(array() AS ARRAY<STRUCT<name: STRING>>) END)"""


def lines_per_order(spark: SparkSession, sf_dir: str, **made: str) -> DataFrame:
    """``l_orderkey -> array of line structs`` in a deterministic order. Only the columns that authors
    are made of are shuffled; ``made`` adds fields to the struct, SQL over these columns, made behind the
    shuffle in generated code (a lambda over the array is interpreted)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *_AUTHOR_LINE).repartition("l_orderkey")
    line = F.struct(*_AUTHOR_LINE, *[F.expr(v).alias(k) for k, v in made.items()])
    return lines.select("l_orderkey", line.alias("s")).groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("s")).alias("lines"))


def order_works(spark: SparkSession, sf_dir: str, run: str = "'orders'",
                extra: tuple[str, ...] = ()) -> DataFrame:
    """One raw work item (JSON text) per order; columns ``raw_item``, ``run`` (``run`` is a SQL
    expression over the order columns, e.g. the order year to spread works over several runs)."""
    # The JVM never compiles methods beyond this size (bytes); Spark then splits the item's projection.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    orders = table(spark, sf_dir, "orders")
    lines = lines_per_order(spark, sf_dir, author=_author_struct())
    # Both sides are dealt by the key, also where the lines seem few: items are made in as many tasks.
    j = orders.join(lines.hint("merge"), orders.o_orderkey == lines.l_orderkey, "left")
    y, m, d = "year(o_orderdate)", "month(o_orderdate)", "day(o_orderdate)"
    nd = "date_add(CAST(o_orderdate AS DATE), 1)"
    ny, nm, ndd = f"year({nd})", f"month({nd})", f"day({nd})"
    published = f"""CASE
        WHEN o_orderkey % 17 = 0 THEN NULL
        WHEN o_orderkey % 37 = 0 THEN parse_json('{{"date-parts":[["x"]]}}')
        WHEN o_orderkey % 47 = 0 THEN parse_json(concat('{{"date-parts":[["', {y}, '","', {m}, '"]]}}'))
        WHEN o_orderkey % 31 = 0 THEN parse_json(concat('{{"date-parts":', {_date_json(y, "13", d)}, '}}'))
        WHEN o_orderkey % 29 = 0 THEN parse_json(concat('{{"date-parts":', {_date_json(f"{y} + 40", m, d)}, '}}'))
        WHEN o_orderkey % 4 = 0 THEN parse_json(concat('{{"date-parts":[[', {y}, ']]}}'))
        WHEN o_orderkey % 4 = 1 THEN parse_json(concat('{{"date-parts":[[', {y}, ',', {m}, ']]}}'))
        ELSE parse_json(concat('{{"date-parts":', {_date_json(y, m, d)}, '}}')) END"""
    issued_src = f"CASE WHEN o_orderkey % 6 = 0 THEN {nd} ELSE CAST(o_orderdate AS DATE) END"
    iy, im, idd = f"year({issued_src})", f"month({issued_src})", f"day({issued_src})"
    indexed_ts = "timestamp_seconds(unix_timestamp(o_orderdate) + o_orderkey)"
    first, last = _four_digits("o_custkey % 10000"), _four_digits("o_orderkey % 10000")
    issn1 = f"concat({first}, '-', {last})"
    issn2 = f"CASE WHEN o_orderkey % 17 = 0 THEN ' ' ELSE concat({last}, '-', {first}) END"
    item = f"""named_struct(
      'DOI', CASE WHEN o_orderkey % 23 = 0 THEN NULL
                  WHEN o_orderkey % 41 = 0 THEN ''
                  WHEN o_orderkey % 43 = 0 THEN '  '
                  ELSE concat(' 10.', CAST(5000 + {PAIR} % 40 AS STRING), '/ORD.', CAST({PAIR} AS STRING), ' ') END,
      'title', CASE WHEN o_orderkey % 13 = 0 THEN NULL
                    WHEN o_orderkey % 19 = 0 THEN array()
                    ELSE array(concat('Order ', CAST(o_orderkey AS STRING), ' priority ', o_orderpriority),
                               concat('Alt ', CAST(o_orderkey AS STRING))) END,
      'original-title', CASE WHEN o_orderkey % 5 = 0 THEN parse_json(concat('["Orig A ', CAST(o_orderkey AS STRING),
                                   '","Orig B ', CAST(o_orderkey AS STRING), '"]'))
                             WHEN o_orderkey % 5 = 1 THEN parse_json(concat('"Orig ', CAST(o_orderkey AS STRING), '"'))
                             WHEN o_orderkey % 5 = 2 THEN parse_json(concat('["Only ', CAST(o_orderkey AS STRING), '"]')) END,
      'container-title', array(concat('Journal ', CAST(o_custkey % 25 AS STRING))),
      'short-container-title', CASE WHEN o_orderkey % 2 = 0 THEN array(concat('J', CAST(o_custkey % 25 AS STRING)))
                                    ELSE array() END,
      'type', CASE o_orderstatus WHEN 'F' THEN 'journal-article' WHEN 'O' THEN 'book-chapter'
                                 ELSE 'proceedings-article' END,
      'publisher', CASE WHEN o_custkey % 31 = 0 THEN NULL ELSE concat('Publisher ', CAST(o_custkey % 30 AS STRING)) END,
      'source', 'metadata-api',
      'prefix', {DOI_PREFIX},
      'member', CAST(o_custkey % 100 AS STRING),
      'score', o_totalprice / 1000,
      'is-referenced-by-count', CASE WHEN o_orderkey % 7 = 0 THEN parse_json(CAST(o_totalprice / 1000 AS STRING))
                                     ELSE parse_json(CAST(CAST(floor(o_totalprice) AS BIGINT) % 500 AS STRING)) END,
      'reference-count', CASE WHEN lines IS NOT NULL THEN size(lines) END,
      'references-count', CASE WHEN o_orderkey % 3 = 0 AND lines IS NOT NULL THEN CAST(size(lines) AS STRING) END,
      'published', {published},
      'published-print', CASE WHEN o_orderkey % 3 = 0 THEN
            parse_json(concat('{{"date-parts":[[', {y}, ',', {m}, ']]}}')) END,
      'published-online', CASE WHEN o_orderkey % 5 = 0 THEN
            parse_json(concat('{{"date-parts":', {_date_json(ny, nm, ndd)}, '}}')) END,
      'issued', parse_json(concat('{{"date-parts":', {_date_json(iy, im, idd)}, '}}')),
      'created', named_struct('date-parts', array(array({y}, {m}, {d})),
                              'date-time', date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
      'deposited', CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE
            named_struct('date-parts', array(array({y}, 1, 1)),
                         'date-time', concat(CAST({y} AS STRING), '-01-01T00:00:00Z')) END,
      'indexed', named_struct('date-parts', array(array(year({indexed_ts}), month({indexed_ts}), day({indexed_ts}))),
                              'date-time', date_format({indexed_ts}, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
      'volume', CAST({y} - 1990 AS STRING),
      'issue', CAST({m} AS STRING),
      'page', concat(CAST({d} AS STRING), '-', CAST({d} + 9 AS STRING)),
      'URL', concat('https://doi.org/', {DOI_PREFIX}, '/ord.', CAST({PAIR} AS STRING)),
      'resource', CASE WHEN o_orderkey % 9 = 0
            THEN parse_json(concat('{{"primary":"https://example.org/ord/', CAST(o_orderkey AS STRING), '"}}'))
            ELSE parse_json(concat('{{"primary":{{"URL":"https://example.org/ord/', CAST(o_orderkey AS STRING), '"}}}}')) END,
      'ISSN', array({issn1}),
      'issn-type', CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE
            array(named_struct('value', {issn1}, 'type', 'print'),
                  named_struct('value', {issn2}, 'type', 'electronic')) END,
      'ISBN', CASE WHEN o_orderstatus = 'O' THEN array(concat('978-', CAST(o_orderkey AS STRING))) END,
      'isbn-type', CASE WHEN o_orderstatus = 'O' THEN
            array(named_struct('value', concat('978-', CAST(o_orderkey AS STRING)), 'type', 'print')) END,
      'alternative-id', CASE WHEN o_orderkey % 10 = 3 THEN NULL
                             WHEN o_orderkey % 2 = 0 THEN array(concat('ALT-', CAST(o_orderkey AS STRING)), '')
                             ELSE array(concat('ALT-', CAST(o_orderkey AS STRING))) END,
      'language', CASE WHEN o_orderkey % 2 = 0 THEN 'en' END,
      'article-number', CASE WHEN o_orderkey % 10 = 0 THEN concat('e', CAST(o_orderkey AS STRING)) END,
      'abstract', CASE WHEN o_orderkey % 4 = 0 THEN
            concat('<jats:p>Order of ', o_orderpriority, ' <b>priority</b></jats:p>') END,
      'license', CASE WHEN o_orderkey % 8 = 0 THEN
            array(named_struct('URL', concat('https://license.example/', CAST(o_orderkey % 3 AS STRING)))) END,
      'author', lines.author,
      'subject', CASE WHEN o_orderkey % 3 = 0 THEN array(o_orderstatus) END,
      'x-priority', o_orderpriority)"""
    return j.selectExpr(f"to_json({item}) AS raw_item", f"CAST({run} AS STRING) AS run", *extra)


# Works per envelope: the page size of one metadata API response.
PAGE_SIZE = 200


def order_envelopes(spark: SparkSession, sf_dir: str, run: str = "year(o_orderdate)") -> DataFrame:
    """API-style envelopes ``{"message": {"items": [...]}}`` of at most ``PAGE_SIZE`` order works
    each (consecutive order keys, one page per run and key range), one JSON document per row
    with its ``run``. A page holds a fixed, bounded number of works, so assembling it never
    gathers an unbounded group."""
    works = order_works(spark, sf_dir, run=run,
                        extra=(f"CAST(floor(o_orderkey / {PAGE_SIZE}) AS BIGINT) AS page",
                               "o_orderkey"))
    pages = works.groupBy("run", "page").agg(
        F.expr("concat('{\"message\":{\"items\":[', "
               "array_join(transform(array_sort(collect_list(struct(o_orderkey, raw_item))), "
               "x -> x.raw_item), ','), ']}}')").alias("envelope"))
    return pages.select("envelope", "run")


def write_year_envelopes(spark: SparkSession, sf_dir: str, path: str) -> None:
    """One envelope file for each order year under ``path``, however large: the text of each file is
    written piece by piece (head, items, end), each piece a row."""
    works = order_works(spark, sf_dir, run="year(o_orderdate)", extra=("o_orderkey",))
    years = works.groupBy("run").agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))
    items = works.join(years, "run").select("run", "o_orderkey", F.concat(
        F.when(F.col("o_orderkey") == F.col("first"), '{"status": "ok", "message": {"items": [').otherwise(","), "raw_item",
        F.when(F.col("o_orderkey") == F.col("last"), F.lit("]}}")).otherwise("")).alias("text"))
    pieces = items.repartition("run").sortWithinPartitions("run", "o_orderkey").select("text", "run")
    with freed_shuffles(spark):
        pieces.write.partitionBy("run").text(path)


def damaged_envelopes(spark: SparkSession, sf_dir: str, run: str = "year(o_orderdate)") -> DataFrame:
    """:func:`order_envelopes` as a faulty source would send them: every seventh page is cut off,
    and in the others every 97th order's item is a bare string instead of an object."""
    works = order_works(spark, sf_dir, run=run,
                        extra=(f"CAST(floor(o_orderkey / {PAGE_SIZE}) AS BIGINT) AS page", "o_orderkey"))
    works = works.withColumn("raw_item", F.expr(
        "CASE WHEN o_orderkey % 97 = 0 THEN concat('\"not an item ', o_orderkey, '\"') ELSE raw_item END"))
    pages = works.groupBy("run", "page").agg(F.expr(
        "concat('{\"status\":\"ok\",\"message\":{\"total-results\":', count(*), ',\"items\":[', "
        "array_join(transform(array_sort(collect_list(struct(o_orderkey, raw_item))), x -> x.raw_item), ','), "
        "']}}')").alias("envelope"))
    cut = F.expr("CASE WHEN page % 7 = 3 THEN left(envelope, length(envelope) - 20) ELSE envelope END")
    return pages.select(cut.alias("envelope"), "run")


def cast_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order: date-time text of many degrees of completeness, and counts as JSON numbers and
    as text with short and long fractions."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        """CASE o_orderkey % 9 WHEN 0 THEN CAST(year(o_orderdate) AS STRING)
                WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM')
                WHEN 2 THEN 'T12:00:00' WHEN 3 THEN '12:00:00'
                WHEN 4 THEN date_format(o_orderdate, 'yyyy-MM-dd')
                WHEN 5 THEN concat(year(o_orderdate), '-13-01T00:00:00Z')
                WHEN 6 THEN 'no date'
                WHEN 7 THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'.25Z'")
                ELSE date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss'Z'") END AS date_time_text""",
        """concat(o_custkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '.5' WHEN 2 THEN '.49999999999'
                  WHEN 3 THEN '.25' ELSE '.50000000001' END) AS number_text""")


def event_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw work per event: the DOI is the user, deposited time is the event time and the
    event's JSON properties plus its type are unmodelled keys (extra metadata)."""
    ev = table(spark, sf_dir, "events")
    item = """to_json(named_struct(
        'DOI', concat('10.9/USER.', CAST(user_id AS STRING)),
        'title', array(concat(event_type, ' ', CAST(event_id AS STRING))),
        'deposited', named_struct('date-time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")),
        'indexed', named_struct('date-time',
            date_format(timestamp_seconds(event_id), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        'event-type', event_type,
        'props', parse_json(props)))"""
    return ev.selectExpr(f"{item} AS raw_item", "'events' AS run")


def page_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw work per web page; the page HTML is the abstract."""
    pg = table(spark, sf_dir, "pages")
    item = """to_json(named_struct(
        'DOI', concat('10.7/PAGE.', CAST(page_id AS STRING)),
        'URL', url,
        'abstract', html))"""
    return pg.selectExpr(f"{item} AS raw_item", "'pages' AS run")


def document_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw work per document: its lines are the title list; a document with one line has
    a plain-string original title; language and source are kept."""
    dc = table(spark, sf_dir, "documents")
    item = """to_json(named_struct(
        'DOI', concat('10.8/DOC.', CAST(doc_id AS STRING)),
        'title', split(text, '\\n'),
        'original-title', CASE WHEN doc_id % 3 = 0 THEN parse_json(to_json(named_struct('v', lang)))
                               ELSE parse_json(to_json(array(lang, source))) END,
        'language', lang,
        'source', source))"""
    return dc.selectExpr(f"{item} AS raw_item", "'documents' AS run")


def conversation_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw work per conversation; each turn is an author: user turns carry a given name,
    assistant turns a family name, system turns only a free-text name."""
    cv = table(spark, sf_dir, "conversations")
    author = """named_struct(
        'given', CASE WHEN role = 'user' THEN concat('U', CAST(turn AS STRING)) END,
        'family', CASE WHEN role = 'assistant' THEN concat('A', CAST(turn % 3 AS STRING)) END,
        'name', CASE WHEN role = 'system' THEN 'System prompt' END,
        'ORCID', CASE WHEN role = 'user' THEN concat('https://orcid.org/0000-0001-0000-',
                      format_string('%04d', turn)) END,
        'sequence', CASE WHEN turn = 0 THEN 'first' ELSE 'additional' END)"""
    # One conversation is one record: its turns are gathered, as the source would deliver them.
    per_conv = cv.groupBy("conv_id").agg(
        F.expr(f"transform(array_sort(collect_list(struct(turn, role, text, {author} AS a))), x -> x.a)")
        .alias("authors"),
        F.expr("array_join(transform(array_sort(collect_list(struct(turn, role, text))), x -> x.text), ' ')")
        .alias("abstract"))
    item = """to_json(named_struct(
        'DOI', concat('10.6/CONV.', CAST(conv_id AS STRING)),
        'title', array(concat('Conversation ', CAST(conv_id AS STRING))),
        'abstract', abstract,
        'author', authors))"""
    return per_conv.selectExpr(f"{item} AS raw_item", "'conversations' AS run")
