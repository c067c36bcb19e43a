"""The registered queries of the corpus operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercatura.llm import bpe, codes, decontaminate, jaccard, langid, lines, mincut, packing, pii, quality, trie, urls, winnow
from mercatura.llm import words as W
from mercatura.session import tune

VOCABULARY = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learnt from the labels of two thirds of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("least")).where("least = 1")
    return quality.classify(docs, trusted).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def held_out() -> Column:
    """Labels of these documents are for testing only."""
    third = F.crc32(F.col("doc_id").cast("string")) % 3
    return F.coalesce(third == 1, F.lit(False))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


_OP2_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{W.UPPER}', '{W.UPPER.lower()}'), '{W.PATTERN}')"

OP2_SQL = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_OP2_WORDS} AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item, {_OP2_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n,
         array_to_string(w[s:s + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram
  FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS s FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT r, s, p.n, item FROM place p JOIN win USING (n, gram)),
covered AS (SELECT r, count(DISTINCT x) AS n_hit
            FROM (SELECT r, unnest(range(s, s + n)) AS x FROM hit) GROUP BY r),
held AS (SELECT r, count(DISTINCT item) AS n_items,
                array_to_string(list_sort(list(DISTINCT item)), ',') AS items FROM hit GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN held USING (r)
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page, with text models from all labelled documents."""
    model = langid.train(table(spark, sf_dir, "documents"))
    host = urls.host_of(F.col("url"))
    host = F.when(host != "", host)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return langid.identify(
        pages, model, "html", markup=True, host=host, suffix=langid.suffix_of(host)
    ).withColumn("confidence", F.round("confidence", 6))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digests(bpe.encode(docs, "text", vocabulary_path()))


def token_digests(encoded: DataFrame) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


# The query's own key; a user brings one from a key store.
PII_KEY = b"pseudonyms of the sample documents"


def op5_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal values replaced, and how many there were."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.protect(docs, PII_KEY).select(
        "doc_id",
        "text",
        F.size("pseudonyms").cast("long").alias("n_values"),
        F.concat_ws(",", F.array_sort(F.array_distinct("pseudonyms.kind"))).alias("kinds"),
    )


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-copy class of every document and the number of documents it is linked to."""
    return jaccard.join(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("stands")


OP6_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {_OP2_WORDS} AS w FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
         FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT x, y FROM pair JOIN size p ON x = p.doc_id JOIN size q ON y = q.doc_id
         WHERE 5 * pair.n >= 4 * (p.n + q.n - pair.n)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT doc_id, least(doc_id, coalesce(min(y), doc_id)) AS class_id,
       (SELECT count(*) FROM link WHERE link.x = doc.doc_id) AS n_links
FROM doc LEFT JOIN reach ON x = doc_id GROUP BY doc_id
"""


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = winnow.with_next(docs, "doc_id", "text", lambda rows: winnow.entries(rows, "text", "entries"))
    done = winnow.edited_entries(
        both, "text", "next_text", "entries", "edited_entries", "edited", "next_entries"
    )
    return done.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        winnow.text_of("entries").alias("fingerprint"),
        winnow.text_of("edited_entries").alias("edited_fingerprint"),
        winnow.likeness(F.col("entries"), F.col("edited_entries")).alias("near_edited"),
        winnow.likeness(F.col("entries"), F.col("next_entries")).alias("near_next"),
    )


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on the URL of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    return urls.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document once each group of like lines is kept in one place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedupe_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("text_sha256")
    )


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return mincut.extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every embedding, with codebooks made from all of them."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    books = codes.fit(rows, "vec_id", "embedding")
    done = codes.encode(rows, "embedding", books).select(
        "vec_id",
        "label",
        F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "").alias("code"),
        "error",
    )
    return codes.with_group_sum(done, "label", "error", "label_error").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


_OP11_ROUND = """
near{n} AS (
  SELECT r, p, min({{'d': list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - y[i]) * (x[i] - y[i]))), 'e': e}}) AS m
  FROM part JOIN book{n} USING (p) GROUP BY r, p),"""
_OP11_BOOK = """
total{n} AS (
  SELECT p, e, i, sum(c) AS s, count(*) AS k
  FROM (SELECT p, m.e AS e, unnest(x) AS c, unnest(range(1, len(x) + 1)) AS i FROM near{o} JOIN part USING (r, p))
  GROUP BY p, e, i),
mean{n} AS (SELECT p, e, list((s - (s % k + k) % k) // k ORDER BY i) AS y FROM total{n} GROUP BY p, e),
book{n} AS (
  SELECT p, e, CAST(coalesce(mean{n}.y, book{o}.y) AS BIGINT[]) AS y FROM book{o} LEFT JOIN mean{n} USING (p, e)),"""

OP11_SQL = f"""
WITH kept AS (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, vec_id, label, v
  FROM (SELECT vec_id, label,
               list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {codes.SCALE}) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
part AS (
  SELECT r, p, v[p * (len(v) // {codes.PARTS}) + 1 : (p + 1) * (len(v) // {codes.PARTS})] AS x
  FROM kept, range({codes.PARTS}) t(p)),
book0 AS (SELECT p, r - 1 AS e, x AS y FROM part WHERE r <= {codes.ENTRIES}),
{_OP11_ROUND.format(n=0)}{_OP11_BOOK.format(n=1, o=0)}{_OP11_ROUND.format(n=1)}{_OP11_BOOK.format(n=2, o=1)}{_OP11_ROUND.format(n=2)}
done AS (
  SELECT r, string_agg(format('{{:02x}}', m.e), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error
  FROM near2 GROUP BY r)
SELECT vec_id, code, error,
       CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, i))
        FROM (SELECT p, e, unnest(y) AS c, unnest(range(len(y))) AS i FROM book2)) AS codebooks_sha256
FROM kept JOIN done USING (r)
"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every prefix that rebuilt conversations share."""
    return trie.trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


# CRC-32 is made of shifts: DuckDB has no function for it.
OP12_SQL = """
WITH RECURSIVE crc(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM crc WHERE k < 8),
steps AS (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
said AS (
  SELECT CAST(conv_id AS BIGINT) AS conv, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv, role, text, row_number() OVER (
    PARTITION BY conv ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS pos FROM said),
heads AS (
  SELECT conv, conv - conv % 100 AS leader, n, xor(list_reduce(
      list_transform(range(1, length(CAST(conv AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv AS VARCHAR)[i]) AS BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 6 AS h
  FROM (SELECT conv, count(*) AS n FROM own GROUP BY conv), steps),
turns AS (
  SELECT a.conv, o.pos, role, text FROM heads a JOIN own o ON o.conv = a.leader AND o.pos <= a.h
  UNION ALL
  SELECT a.conv, o.pos, role, text FROM heads a JOIN own o ON o.conv = a.conv AND o.pos > a.h),
placed AS (
  SELECT conv, role, text, row_number() OVER (PARTITION BY conv ORDER BY pos) AS depth FROM turns),
prefix AS (
  SELECT conv, CAST(0 AS BIGINT) AS depth, CAST([] AS VARCHAR[]) AS path, CAST(0 AS BIGINT) AS chars FROM heads
  UNION ALL
  SELECT p.conv, p.depth, list_append(f.path, p.role || chr(1) || length(p.role) || chr(1) || p.text), length(p.text)
  FROM prefix f JOIN placed p ON p.conv = f.conv AND p.depth = f.depth + 1),
ending AS (SELECT conv, max(depth) AS depth FROM prefix GROUP BY conv),
node AS (
  SELECT p.path, p.depth, min(p.conv) AS conv, count(*) AS n, min(chars) AS chars,
         list(p.conv ORDER BY p.conv) FILTER (e.depth = p.depth) AS ends
  FROM prefix p JOIN ending e USING (conv) GROUP BY p.path, p.depth),
children AS (SELECT path[:depth - 1] AS path, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
marked AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN children USING (path)),
subtree AS (
  SELECT path[:d] AS path, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves,
         CAST(sum((n - 1) * chars) AS BIGINT) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM marked) GROUP BY 1)
SELECT m.conv AS conv_id, m.depth, up.conv AS parent_conv_id, m.n AS n_convs, m.n_children, n_leaves,
       saved AS saved_tokens, sha256(coalesce(array_to_string(m.ends, ','), '')) AS ends_sha256
FROM marked m JOIN subtree s ON s.path = m.path
LEFT JOIN node up ON m.depth > 0 AND up.depth = m.depth - 1 AND up.path = m.path[:m.depth - 1]
"""


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, and where it lies in which sequence."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, vocabulary_path()).select(
        "doc_id",
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )


_OP8_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in urls.RULES)

OP8_SQL = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_OP8_RULES}),
cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
                       ELSE '' END AS rest
  FROM pages),
named AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{urls.UPPER}',
                            '{urls.UPPER.lower()}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut)
SELECT page_id, host, path,
       (SELECT rule_host || rule_path FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
          AND starts_with(path, rule_path)
        ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM rules
        WHERE (host = rule_host OR ends_with(host, '.' || rule_host))
          AND starts_with(path, rule_path)
        ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
FROM named
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_decontaminate": op2_decontaminate,
        "op3_language": op3_language,
        "op4_bpe": op4_bpe,
        "op5_pseudonyms": op5_pseudonyms,
        "op6_jaccard": op6_jaccard,
        "op7_fingerprints": op7_fingerprints,
        "op8_url_filter": op8_url_filter,
        "op9_line_dedup": op9_line_dedup,
        "op10_main_text": op10_main_text,
        "op11_vector_codes": op11_vector_codes,
        "op12_prefix_trie": op12_prefix_trie,
        "op13_packing": op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2_SQL, "op6_jaccard": OP6_SQL, "op8_url_filter": OP8_SQL, "op11_vector_codes": OP11_SQL, "op12_prefix_trie": OP12_SQL}
