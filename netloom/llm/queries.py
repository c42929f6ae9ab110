"""The registered queries of this folder, ``(spark, sf_dir) -> DataFrame``, and
their DuckDB SQL where SQL can express them. Each applies one operator, with
its default parameters, to its whole table."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netloom.llm import align, bpe, decontam, jaccard, mixing, omh, orcids, ppm, secrets, topk, toxicity, turns, urltree
from netloom.session import scratch_root

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@_query
def op1_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@_query
def op2_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    rows = ppm.score(_read(spark, sf_dir, "documents"), ~held_out)
    return rows.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op3_toxic_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    teaches = toxicity.may_learn(F.col("doc_id"))
    model = toxicity.learn(docs, _read(spark, sf_dir, "labels"), teaches)
    rows = toxicity.score(docs, model).withColumnRenamed("toxicity", "score")
    held_out = F.coalesce(~teaches, F.lit(False)).alias("held_out")
    return rows.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@_query
def op4_url_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urltree.judge(_read(spark, sf_dir, "pages"))


@_query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jaccard.join(_read(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id")


@_query
def op6_orc_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_root(spark)}/orc-ids-{uuid.uuid4().hex}"
    tokenizer = orcids.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    orcids.write(_read(spark, sf_dir, "documents"), path, tokenizer, end_id=0)
    rows = orcids.with_starts(orcids.checksums(orcids.read(spark, path)))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


@_query
def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = omh.compare(_read(spark, sf_dir, "documents"))
    prints = [omh.as_string(F.col(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return rows.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next")


@_query
def op8_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    rows = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    return rows.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@_query
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op10_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger takes the table in two versions, half of the documents and then
    all of them: the second scans only blobs that the first did not hold."""
    docs = _read(spark, sf_dir, "documents")
    ledger = secrets.Ledger(spark, f"{scratch_root(spark)}/ledger-{uuid.uuid4().hex}")
    ledger.update(docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0))
    ledger.update(docs)
    found = secrets.findings(ledger.rows())
    rows = secrets.paths_with_findings(docs, found, "doc_id")

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda s: s["rank"] < len(secrets.BASE))
    return rows.select(
        "doc_id",
        *[count(r.kind).alias(f"n_{r.kind}") for r in secrets.BASE],
        F.sha2(joined(F.sort_array(F.transform(base, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))), 256).alias("base_sha256"),
        joined(F.sort_array(F.transform(F.col("spans"), lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"])))).alias("spans"),
    )


@_query
def op11_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontam.contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    items = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return rows.select("doc_id", "n_words", "n_hit", "n_items", items, "contaminated")


@_query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repair(turns.damage(_read(spark, sf_dir, "conversations")))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return align.compare(_read(spark, sf_dir, "documents"), *paths)


# ---- SQL ------------------------------------------------------------------------

ORACLES["op1_top_inner_products"] = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         q AS (SELECT vec_id, min(v) AS v FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
         s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
               FROM q a JOIN v b ON a.vec_id <> b.vec_id),
         r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10"""

ORACLES["op5_jaccard_join"] = r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
         s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
            range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
         e AS (SELECT doc_id, unnest(s) AS g FROM s),
         n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s),
         p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
         l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
         b AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
         r AS (SELECT doc_id AS d, doc_id AS c FROM n UNION SELECT r.d, b.y FROM r JOIN b ON r.c = b.x)
    SELECT n.doc_id, n.n AS n_shingles, c.component_id
    FROM n JOIN (SELECT d, min(c) AS component_id FROM r GROUP BY d) c ON n.doc_id = c.d"""


def _secret_sql() -> str:
    def spans(rank: int, rule: secrets.Rule) -> str:
        # possessive repeats, which take no stack, match what plain ones match here
        pattern = re.sub(r"(?<=[*+}])\+", "", rule.pattern).replace("'", "''")
        return f"""
            SELECT doc_id, {rank} AS rank, '{rule.kind}' AS kind, unnest(list_transform(range(1, len(f) + 1), lambda i: {{
                'at': list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0),
                'n': length(f[i]), 'w': length(g[i])}})) AS m
            FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}', 0) AS f, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
                         string_split_regex(t, '{pattern}') AS gaps FROM d WHERE regexp_matches(t, '{pattern}')) x"""

    # rules of one text: a filter on the weighed group comes after matching
    parts = [f"SELECT * FROM ({spans(i, r)}) y WHERE m.w >= {r.least}" for i, r in enumerate(secrets.RULES)]
    joined = "string_agg(kind || ':' || CAST(m.at AS BIGINT) || ':' || CAST(m.at + m.n AS BIGINT), ',' ORDER BY m.at, rank, m.n)"
    base = len(secrets.BASE)
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{r.kind}') AS n_{r.kind}" for r in secrets.BASE)
    given = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secrets.BASE)
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
         m AS ({" UNION ALL ".join(parts)}),
         a AS (SELECT doc_id, {counts}, {joined} FILTER (WHERE rank < {base}) AS base, {joined} AS spans FROM m GROUP BY doc_id)
    SELECT d.doc_id, {given}, sha256(coalesce(a.base, '')) AS base_sha256, coalesce(a.spans, '') AS spans
    FROM d LEFT JOIN a ON d.doc_id = a.doc_id"""


ORACLES["op10_secret_ledger"] = _secret_sql()

ORACLES["op11_benchmark_windows"] = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
         i AS (SELECT item_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
         f AS (SELECT item_id, w, least(len(w), 10) AS k FROM i WHERE len(w) > 0),
         x AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM f),
         g AS (SELECT DISTINCT item_id, k, array_to_string(w[s:s + k - 1], ' ') AS g FROM x),
         p AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM f) WHERE len(w) >= k),
         h AS (SELECT p.r, p.s, p.k, g.item_id FROM p JOIN g ON p.k = g.k AND array_to_string(p.w[p.s:p.s + p.k - 1], ' ') = g.g),
         n AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS place FROM h) GROUP BY r),
         e AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit, coalesce(e.n_items, 0) AS n_items,
           sha256(coalesce(e.items, '')) AS items_sha256, coalesce(n.n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN n ON d.r = n.r LEFT JOIN e ON d.r = e.r"""

# all edits row by row: in each state of the roles' grammar, the least (cost, audit, text) so far
ORACLES["op12_conversation_repair"] = r"""
    WITH RECURSIVE c AS (SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k,
                coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM conversations),
         bits AS (SELECT DISTINCT k, list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                lambda h, b: list_reduce(list_concat([xor(h, b)], range(8)),
                    lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)) AS h FROM c),
         way AS (SELECT c.*, xor(h, 4294967295) % 20 AS way FROM c JOIN bits ON c.k = bits.k),
         rows_ AS (SELECT conv_id, turn, CASE WHEN way = 4 THEN 'user' ELSE role END AS role,
                CASE WHEN way = 1 THEN '' WHEN way = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN way = 3 THEN [1, 2] WHEN way = 0 THEN [] ELSE [1] END) AS copy FROM way),
         o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rows_),
         s AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen,
                lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
         f AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen THEN 'duplicate'
                WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault FROM s),
         m AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                count(*) FILTER (WHERE pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
         step AS (SELECT * FROM (VALUES ('0', 's', 's'), ('0', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')) t(x, role, y)),
         ins AS (SELECT x, x AS y, 0 AS k, '' AS lines FROM (VALUES ('0'), ('s'), ('u'), ('a')) t(x)
                 UNION ALL SELECT x, y, 1, CASE role WHEN 'u' THEN 'user:' ELSE 'assistant:' END || chr(10) FROM step WHERE role <> 's'
                 UNION ALL SELECT a.x, b.y, 2, CASE a.role WHEN 'u' THEN 'user:' || chr(10) || 'assistant:' ELSE 'assistant:' || chr(10) || 'user:' END || chr(10)
                 FROM step a JOIN step b ON a.y = b.x WHERE a.role <> 's' AND b.role <> 's'),
         dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS i, '0' AS x, {'c': CAST(0 AS BIGINT), 'a': '', 't': ''} AS b FROM m
                UNION ALL
                SELECT conv_id, i, y, min(b) FROM (
                    SELECT dp.conv_id, f.i, e.y, {'c': CAST(dp.b.c + 2 * ins.k + e.cost AS BIGINT), 'a': dp.b.a || repeat('I', ins.k) || e.edit,
                            't': dp.b.t || ins.lines || e.line} AS b
                    FROM dp JOIN ins ON ins.x = dp.x JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1,
                    LATERAL (SELECT ins.y AS y, 3 AS cost, 'D' AS edit, '' AS line
                             UNION ALL SELECT step.y, CAST(f.fault = 'truncated' AS INTEGER), 'K', f.role || ':' || f.text || chr(10)
                             FROM step WHERE step.x = ins.y AND step.role = left(f.role, 1) AND f.fault IN ('', 'truncated')
                             UNION ALL SELECT step.y, 2 + CAST(f.fault = 'truncated' AS INTEGER), 'R',
                                    CASE step.role WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || f.text || chr(10)
                             FROM step WHERE step.x = ins.y AND step.role <> 's' AND f.fault IN ('', 'truncated')) e) z
                GROUP BY conv_id, i, y),
         e AS (SELECT dp.conv_id, min({'c': CAST(dp.b.c + 2 * ins.k AS BIGINT), 'a': dp.b.a || repeat('I', ins.k), 't': dp.b.t || ins.lines}) AS b
               FROM dp JOIN m ON m.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = m.n JOIN ins ON ins.x = dp.x
               WHERE ins.y IN ('0', 'a') GROUP BY dp.conv_id)
    SELECT q.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, coalesce(e.b.c, 0) AS cost, coalesce(e.b.a, '') AS audit,
           sha256(CASE WHEN e.b.t IS NULL OR e.b.t = '' THEN '' ELSE e.b.t[:-2] END) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) q LEFT JOIN m ON m.conv_id IS NOT DISTINCT FROM q.conv_id
    LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM q.conv_id"""
