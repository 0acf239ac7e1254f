"""The thin queries over the operators of this subpackage, one for each, and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenfold.llm import decontaminate, exact_dedup, fingerprints, importance, line_dedup, lm_scores, mixing, periodic_runs, quality, shared, simhash_dedup, suffix_dedup, token_files, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

END_ID = 2


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_suffix_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(spark, table(spark, sf_dir, "documents"), length=100).drop("spans")


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(spark, table(spark, sf_dir, "documents"), words=3, radius=3)


#: One round of templates: groups of lines, their constants, the lines that fit, and what is left divided.
OP3_ROUND = """
v{i} AS MATERIALIZED (
  SELECT grp, pos, token, sum(n) AS n FROM (SELECT grp, n, unnest(range(1, len(tokens) + 1)) AS pos, unnest(tokens) AS token FROM g{i}) GROUP BY grp, pos, token
), c{i} AS MATERIALIZED (
  SELECT grp, pos, token FROM (SELECT *, sum(n) OVER (PARTITION BY grp, pos) AS total FROM v{i}) WHERE 2 * n > total
), f{i} AS MATERIALIZED (
  SELECT x.grp, x.kind FROM (SELECT grp, kind, len(tokens) AS size, unnest(range(1, len(tokens) + 1)) AS pos, unnest(tokens) AS token FROM g{i}) x
  LEFT JOIN c{i} c ON x.grp = c.grp AND x.pos = c.pos AND x.token = c.token
  GROUP BY x.grp, x.kind HAVING 2 * count(c.token) >= any_value(x.size)
), r{i} AS MATERIALIZED (
  SELECT g.*, sum(n) OVER (PARTITION BY grp) AS total FROM g{i} g WHERE kind NOT IN (SELECT kind FROM f{i})
), w{i} AS MATERIALIZED (
  SELECT grp, pos, token, sum(n) AS n FROM (SELECT grp, n, total, unnest(range(1, len(tokens) + 1)) AS pos, unnest(tokens) AS token FROM r{i})
  WHERE pos > 3 AND grp NOT IN (SELECT grp FROM f{i}) GROUP BY grp, pos, token HAVING sum(n) >= 10 AND sum(n) < any_value(total)
), b{i} AS MATERIALIZED (
  SELECT grp, pos FROM (SELECT grp, pos, sum(n) AS n FROM w{i} GROUP BY grp, pos) QUALIFY row_number() OVER (PARTITION BY grp ORDER BY n DESC, pos) = 1
), g{j} AS MATERIALIZED (
  SELECT r.grp || chr(10) || coalesce(b.pos || ' ' || coalesce('=' || w.token, ''), '') AS grp, r.kind, r.tokens, r.n
  FROM r{i} r LEFT JOIN b{i} b ON r.grp = b.grp LEFT JOIN w{i} w ON w.grp = b.grp AND w.pos = b.pos AND w.token = r.tokens[b.pos]
),"""

OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, hash(text) AS t, unnest(range(0, len(string_split(text, chr(10))))) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents
), tok AS (
  SELECT doc_id, t, line_no, list_filter(regexp_split_to_array(regexp_replace(line, '[0-9]+', '0', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS tokens FROM lines
), leafed AS (
  SELECT doc_id, t, line_no, tokens, array_to_string(tokens, ' ') AS kind, len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf FROM tok WHERE len(tokens) > 0
), common AS (
  SELECT leaf FROM leafed WHERE len(tokens) >= 4 GROUP BY leaf HAVING count(DISTINCT t) >= 10
), here AS (
  SELECT * FROM leafed WHERE leaf IN (SELECT leaf FROM common)
), g0 AS MATERIALIZED (
  SELECT leaf AS grp, kind, tokens, count(*) AS n FROM here GROUP BY leaf, kind, tokens
),""" + "".join(OP3_ROUND.format(i=i, j=i + 1) for i in range(line_dedup.ROUNDS)) + r"""
general AS (
  """ + " UNION ALL ".join(f"SELECT grp, kind FROM f{i}" for i in range(line_dedup.ROUNDS)) + r"""
), recurring AS (
  SELECT g.grp FROM general g JOIN here h ON g.kind = h.kind GROUP BY g.grp HAVING count(DISTINCT h.t) >= 10
), dropped AS (
  SELECT kind FROM leafed GROUP BY kind HAVING count(DISTINCT t) >= CASE WHEN any_value(len(tokens)) < 4 THEN 10 ELSE 3 END
  UNION
  SELECT g.kind FROM general g JOIN recurring r ON g.grp = r.grp
), gone AS (
  SELECT doc_id, line_no FROM leafed WHERE kind IN (SELECT kind FROM dropped)
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.line_no)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.line_no) FILTER (WHERE g.line_no IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.line_no = g.line_no
GROUP BY l.doc_id
"""


@query("op3_line_dedup", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_recurring_lines(spark, table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_token_files")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.new_path(spark, "op4-tokens")
    parts = token_files.write_token_files(spark, table(spark, sf_dir, "documents"), path, tokenizer_path(), END_ID)
    return token_files.read_token_files(spark, path, parts)


#: Target weights of the sources; a source that isn't named has weight 1.
WEIGHTS = {"src0": 8, "src1": 4, "src2": 4, "src3": 2, "src4": 2, "src5": 2}
MIX_BLOCK = 16

OP5_SQL = f"""
WITH RECURSIVE c AS (
  SELECT source, CASE source {" ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items())} ELSE 1 END::BIGINT AS w
  FROM documents GROUP BY source
), s AS (
  SELECT list(source ORDER BY source NULLS FIRST) AS names, list(w ORDER BY source NULLS FIRST) AS w, sum(w)::BIGINT AS total FROM c
), sim AS (
  SELECT 0::BIGINT AS slot, list_transform(w, lambda x: 0::BIGINT) AS done, NULL::BIGINT AS i, NULL::BIGINT AS ordinal, NULL::BIGINT AS deadline FROM s
  UNION ALL
  SELECT slot + 1, list_transform(done, lambda d, k: d + CASE WHEN k = pick.i THEN 1 ELSE 0 END), pick.i, done[pick.i], pick.d
  FROM (
    SELECT slot, done, total,
      list_min(list_filter(list_transform(w, lambda x, k: CASE WHEN (done[k] * total) // x <= slot
        THEN {{'d': ((done[k] + 1) * total + x - 1) // x, 'heavy': -x, 'i': k::BIGINT}} END), lambda o: o IS NOT NULL)) AS pick
    FROM sim, s WHERE slot < total
  )
), cycle AS (
  SELECT names[i] AS source, w[i] AS w, total, slot - 1 AS slot, ordinal, (ordinal * total) // w[i] AS release, deadline
  FROM sim, s WHERE i IS NOT NULL
), r AS (
  SELECT doc_id, source, length(text)::INTEGER AS text_chars, sha256(coalesce(text, '')) AS text_sha256,
         row_number() OVER (PARTITION BY source ORDER BY doc_id, text) - 1 AS rank FROM documents
), b AS (
  SELECT r.*, rank // {MIX_BLOCK} AS block FROM r
), p AS (
  SELECT b.doc_id, b.source, b.text_chars, b.text_sha256, b.rank, b.block, (b.block // k.w) * k.total + k.slot AS slot,
         (b.block // k.w) * k.total + k.release AS release, (b.block // k.w) * k.total + k.deadline AS deadline
  FROM b JOIN cycle k ON b.source = k.source AND b.block % k.w = k.ordinal
)
SELECT doc_id, source, text_chars, text_sha256, block, slot, release, deadline, row_number() OVER (ORDER BY slot, rank) - 1 AS position FROM p
"""


@query("op5_mixing", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, MIX_BLOCK)
    return mixed.select("doc_id", "source", F.char_length("text").alias("text_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"), *mixing.ADDED)


@query("op6_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_lm_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = table(spark, sf_dir, "labels").where("quality = 1 AND toxic = 0").select("doc_id")
    return lm_scores.cross_entropy_difference(spark, table(spark, sf_dir, "documents"), target)


@query("op8_decontaminate")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_fingerprints")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, and for those whose id is divisible by 100 how many other
    documents the block tables find within 3 bits."""
    rows = shared.write_table(spark, fingerprints.fingerprint_edits(table(spark, sf_dir, "documents")), "fingerprinted")
    return fingerprints.documents_within(rows, F.col("doc_id") % 100 == 0, radius=3, blocks=6).drop("fp")


OP10_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), bits AS (
  SELECT DISTINCT hex,
    array_to_string(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + (('0x' || substr(hex, 1 + (i * 5) // 4, 2))::INTEGER * 16
             + (CASE WHEN (i * 5) // 4 + 3 <= 40 THEN ('0x' || substr(hex, 3 + (i * 5) // 4, 1))::INTEGER ELSE 0 END)
             >> (7 - (i * 5) % 4)) % 32, 1)), '') AS digest
  FROM (SELECT DISTINCT hex FROM p)
), k AS (SELECT hex, max(page_id) AS keeper FROM p GROUP BY hex)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM p JOIN bits USING (hex) JOIN k USING (hex)
"""


@query("op10_warc", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write_warc(spark, table(spark, sf_dir, "pages"), shared.new_path(spark, "op10-warc"), min_bytes=0)
    return warc.read_warc(spark, files)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document, by a hash of its id, gets a periodic end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), "")
    n = F.size("words")
    a = F.when(n > 0, g % F.greatest(n, F.lit(1))).otherwise(0).cast("int")
    period = (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    times = F.ceil((n - F.col("a")) / F.col("period")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("period")), times)), F.lit(1), n - F.col("a"))
    edited = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), tail), " ")
    chosen = docs.select("doc_id", "text", g.alias("g"), F.when(h % 10 == 0, words).alias("words"))
    spots = chosen.withColumn("a", a).withColumn("period", period)
    return spots.select("doc_id", F.when(F.col("words").isNotNull() & (n > 0), edited).otherwise(F.col("text")).alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.with_runs(with_planted_periods(table(spark, sf_dir, "documents")))
    # Of two runs the first has the greater exponent if its length times the other's period is more.
    first = F.aggregate("runs", F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), first.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period", F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"
    )


OP12_SQL = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
), o AS (
  SELECT doc_id, body, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY body) AS group_size, row_number() OVER w AS place
  FROM n WINDOW w AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM o
"""


@query("op12_exact_dedup", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.owners(spark, table(spark, sf_dir, "documents")).drop("chars")


@query("op13_importance")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
