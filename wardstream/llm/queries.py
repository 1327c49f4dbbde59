"""The registered queries over the training-data tables, and their SQL where SQL can say it."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstream.llm import (
    align,
    chat,
    decontaminate,
    fertility,
    line_dedup,
    main_text,
    near_dup,
    piece_fst,
    prefix_bpe,
    resample,
    secrets,
    sharding,
    zip_warc,
)
from wardstream.llm.common import table
from wardstream.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# 8. Sharding.


@query
def op8_interleaved_shards(spark, sf_dir):
    """All documents in eight shards of the corpus mixture."""
    sized = table(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    return sharding.interleave(sized, "doc_id", "source").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


ORACLE["op8_interleaved_shards"] = """
WITH crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(range(8), lambda c, k:
                 CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
        FROM range(256) r(i))
), sized AS (
  SELECT doc_id, coalesce('=' || source, '') AS stratum,
         coalesce(strlen(text), 0)::BIGINT + 1 AS size,
         hex(encode(coalesce(text, ''))) AS x,
         md5('1:' || coalesce(doc_id::VARCHAR, 'null')) AS o
  FROM documents
), ranked AS (
  SELECT *, (2 * row_number() OVER (PARTITION BY stratum ORDER BY o) - 1)::DOUBLE
            / (2 * count(*) OVER (PARTITION BY stratum))::DOUBLE AS frac
  FROM sized
), placed AS (
  SELECT *, row_number() OVER (ORDER BY frac, stratum, o) - 1 AS p, count(*) OVER () AS n
  FROM ranked
)
SELECT doc_id, size,
       xor(4294967295, list_reduce(range(length(x) // 2), lambda c, j:
             xor(t[xor(c, ('0x' || substr(x, 2 * j + 1, 2))::BIGINT) % 256 + 1], c // 256),
             4294967295)) AS text_crc32,
       'rows' AS law, (p * 8 // n)::INTEGER AS shard,
       (p - ((p * 8 // n) * n + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed, crc
"""


# 1. Benchmark decontamination.


@query
def op1_winnowed_leaks(spark, sf_dir):
    """Words of each document that repeat ten words of a benchmark item."""
    found = decontaminate.shared_spans(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    n_hit = decontaminate.covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op1_winnowed_leaks"] = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_WORDS} AS w FROM benchmark),
wi AS (
  SELECT DISTINCT item, least(len(w), 10) AS m,
         array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS p FROM i)
),
wd AS (
  SELECT r, m, p, array_to_string(w[p:p + m - 1], ' ') AS win
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS p
        FROM d, (SELECT DISTINCT m FROM wi))
),
hits AS (SELECT r, p, m, item FROM wd JOIN wi USING (m, win)),
hit_words AS (
  SELECT r, count(DISTINCT x) AS n FROM (SELECT r, unnest(range(p, p + m)) AS x FROM hits)
  GROUP BY r
),
hit_items AS (
  SELECT r, count(DISTINCT item) AS n,
         sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS s
  FROM hits GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(a.n, 0)::BIGINT AS n_hit,
       coalesce(b.n, 0)::BIGINT AS n_items, coalesce(b.s, sha256('')) AS items_sha256,
       coalesce(a.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words a USING (r) LEFT JOIN hit_items b USING (r)
"""


# 3. Quality rules.


@query
def op3_fertility_rules(spark, sf_dir):
    """Base rules and tokeniser fertility of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fertility.kept(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_tokens",
        F.round("chars_per_token", 6).alias("chars_per_token"),
        F.round("byte_share", 6).alias("byte_share"),
        F.round("entropy", 6).alias("entropy"),
        "script",
    )


# 10. SentencePiece encoding and decoding.


@query
def op10_piece_transducer(spark, sf_dir):
    """The piece ids of every document, and whether they spell it again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return piece_fst.encode(docs, again="spelled_again").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.size(F.filter("ids", lambda i: i.between(*piece_fst.byte_range()))).cast("long").alias("n_byte_pieces"),
        "spelled_again",
        "ids",
    )


# 4. WARC.


@query
def op4_zip_warc(spark, sf_dir):
    """All pages as WARC records in ZIP packages, read back from there."""
    path = scratch_dir(spark, "packages")
    zip_warc.write_packages(table(spark, sf_dir, "pages"), path)
    found = zip_warc.resolved(zip_warc.read_packages(spark, path))

    def page(record: str):
        return F.regexp_extract(record, "^<urn:page:(.*)>$", 1).try_cast("long")

    return found.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to_id").alias("refers_to"),
    )


ORACLE["op4_zip_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha1(coalesce(html, '')) AS x FROM pages),
bits AS (
  SELECT page_id, octet_length(b)::BIGINT AS n, x, max(page_id) OVER (PARTITION BY x) AS last,
         list_transform(range(8), lambda i: ('0x' || substr(x, 5 * i + 1, 5))::BIGINT) AS g
  FROM p
)
SELECT page_id, n AS payload_bytes,
       list_reduce(list_transform(range(32), lambda j:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((g[j // 4 + 1] >> (15 - 5 * (j % 4))) & 31)::INTEGER + 1, 1)),
         lambda a, c: a || c) AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits
"""


# 2. Chat formatting.


@query
def op2_chat_windows(spark, sf_dir):
    """All conversations and one of control strings, formatted in windows and read back."""
    said = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.sql(
        "SELECT bigint(-1) AS conv_id, bigint(turn) AS turn, role, '</s>[INST] ok [/INST]' AS text"
        " FROM VALUES (0, 'user'), (1, 'assistant') AS t(turn, role)"
    )
    formatted = chat.windows(said.unionByName(hostile))
    turns = F.slice(
        chat.read_back(F.col("formatted")), F.col("n_masked") + 1, F.length("formatted") + 1
    )
    one = F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = formatted.select(
        "conv_id",
        F.size(turns).cast("long").alias("n"),
        F.length("formatted").cast("long").alias("chars"),
        F.struct("window", F.concat_ws("", one).alias("text")).alias("spoken"),
        F.struct(
            "window",
            F.concat_ws("", chat.under_loss(F.col("formatted"), F.col("loss"))).alias("text"),
        ).alias("trained"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.concat_ws("", F.sort_array(F.collect_list("spoken"))["text"]).alias("spoken"),
        F.concat_ws("", F.sort_array(F.collect_list("trained"))["text"]).alias("trained"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2("spoken", 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"),
        "formatted_chars",
    )


# 6. Line de-duplication.


@query
def op6_winnowed_lines(spark, sf_dir):
    """All documents without the later occurrences of repeated runs of lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs)


ORACLE["op6_winnowed_lines"] = r"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), units AS (
  SELECT doc_id, i, j, md5(line) || ':' || j AS u
  FROM (SELECT *, unnest(range(1, least(5, (len(regexp_extract_all(line, '[^\x09-\x0D\x20]+')) + 9) // 10) + 1)) AS j
        FROM lines)
), runs AS (
  SELECT doc_id, i AS first, row_number() OVER w AS pos,
         u || lead(u, 1) OVER w || lead(u, 2) OVER w || lead(u, 3) OVER w || lead(u, 4) OVER w AS r,
         lead(i, 4) OVER w AS last
  FROM units WINDOW w AS (PARTITION BY doc_id ORDER BY i, j)
), later AS (
  SELECT doc_id, first, last
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY doc_id, pos) AS k FROM runs WHERE r IS NOT NULL)
  WHERE k > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM later
)
SELECT d.doc_id,
       CASE WHEN any_value(d.text) IS NOT NULL
            THEN coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '') END AS text,
       CASE WHEN any_value(d.text) IS NULL THEN 0 ELSE count(*) END::BIGINT AS n_lines,
       count(g.i)::BIGINT AS n_deleted
FROM documents d JOIN lines l USING (doc_id) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
GROUP BY d.doc_id
"""


# 7. Secret scans.


@query
def op7_markov_secrets(spark, sf_dir):
    """Secrets in all documents."""
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(rank: int):
        return F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
    )


# 5. MinHash near-dedup.


@query
def op5_weighted_minhash(spark, sf_dir):
    """The class of near-duplicates of every document."""
    return near_dup.classes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "class_id", "class_size", (F.col("doc_id") == F.col("class_id")).alias("kept")
    )


# 9. HTML extraction.


@query
def op9_host_suffixes(spark, sf_dir):
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


# 11. Byte-level BPE encoding and decoding.


@query
def op11_prefix_bpe(spark, sf_dir):
    """The byte-level ids of every document, and what they decode to."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return prefix_bpe.encode(docs, packed=True, decoded="decoded").select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# 12. Cross-tokenizer alignment.


@query
def op12_diagonal_runs(spark, sf_dir):
    """Byte-level tokens of all documents aligned with pieces."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align.linked(docs)[0]


# 13. Target-distribution importance resampling.


@query
def op13_bracketed_resample(spark, sf_dir):
    """A quarter of the documents, drawn towards the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resample.resample(docs, table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op13_bracketed_resample"] = f"""
WITH crc AS (
  SELECT list(c ORDER BY i) AS t
  FROM (SELECT i, list_reduce(range(8), lambda c, k:
                 CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i) AS c
        FROM range(256) r(i))
),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT {_WORDS} AS w FROM benchmark),
fd AS (
  SELECT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1]))) AS f FROM d
),
fi AS (
  SELECT unnest(list_concat(w, list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1]))) AS f FROM i
),
bucket AS (
  SELECT f, xor(4294967295, list_reduce(range(length(x) // 2), lambda c, j:
              xor(t[xor(c, ('0x' || substr(x, 2 * j + 1, 2))::BIGINT) % 256 + 1], c // 256),
              4294967295)) % 10000 AS b
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM fd UNION SELECT f FROM fi)), crc
),
total AS (SELECT (SELECT count(*) FROM fd)::DOUBLE AS s, (SELECT count(*) FROM fi)::DOUBLE AS t),
ds AS (SELECT b, count(*) AS s FROM fd JOIN bucket USING (f) GROUP BY b),
dt AS (SELECT b, count(*) AS t FROM fi JOIN bucket USING (f) GROUP BY b),
gain AS (
  SELECT r.b, floor(1000 * ln((coalesce(dt.t, 0) + 1)::DOUBLE * (total.s + 10000)
                              / ((coalesce(ds.s, 0) + 1)::DOUBLE * (total.t + 10000))))::BIGINT AS g
  FROM range(10000) r(b) LEFT JOIN ds USING (b) LEFT JOIN dt USING (b), total
),
mean AS (
  SELECT doc_id, count(*) AS n, sum(g)::BIGINT AS g FROM fd JOIN bucket USING (f) JOIN gain USING (b) GROUP BY doc_id
),
scored AS (
  SELECT d.doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features,
         coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT AS weight,
         coalesce((g - ((g % n) + n) % n) // n, 0)::BIGINT + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('7:' || d.doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN mean USING (doc_id)
),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN k <= 25 * n // 100 THEN k END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""
