"""The operators' queries over the given tables, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareflow.llm import (decontaminate, exact_dedup, importance, infill, jaccard_join, language_model, licenses, packing, quality, suffix_dedup,
                          token_counts, token_shards, toxicity)
from wareflow.llm.common import documents, ship
from wareflow.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(ship(spark))
            return fn(spark, sf_dir.rstrip("/"))
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql.strip()
        return run
    return deco


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_decontamination")
def op1(spark, sf_dir):
    return decontaminate.leaks(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


@query("op2_language_model")
def op2(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = language_model.train(docs.where(~language_model.held_out()))
    return language_model.score(docs, model, extra={"held_out": language_model.held_out()})


@query("op3_packing")
def op3(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir))


@query("op4_token_shards")
def op4(spark, sf_dir):
    return token_shards.write_shards(documents(spark, sf_dir), token_shards.default_folder(spark))


@query("op5_jaccard_join")
def op5(spark, sf_dir):
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


@query("op6_exact_dedup", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS raw FROM documents),
n AS (SELECT doc_id, length(raw) AS chars, sha256(regexp_replace(raw, '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256 FROM t),
o AS (SELECT text_sha256, first(doc_id ORDER BY chars DESC, doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY text_sha256)
SELECT n.doc_id, o.keep_id, o.group_size, n.doc_id = o.keep_id AS kept, n.text_sha256 FROM n JOIN o USING (text_sha256)
""")
def op6(spark, sf_dir):
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


@query("op7_licenses")
def op7(spark, sf_dir):
    return licenses.scan(documents(spark, sf_dir))


@query("op8_token_counts")
def op8(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir))


@query("op9_toxicity")
def op9(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


@query("op10_suffix_dedup")
def op10(spark, sf_dir):
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


#: CRC-32 of a word by its bytes: eight shifts (-1) after each; DuckDB has no such function.
_CRC_SQL = """
xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(0, octet_length(encode(word))),
    lambda i: [('0x' || substr(hex(encode(word)), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))
"""
_LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS_SQL = f"regexp_extract_all({_LOWER_SQL}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


@query("op11_importance_resampling", f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS_SQL} AS words FROM documents),
dw AS (SELECT row, word, count(*) AS c FROM (SELECT row, unnest(words) AS word FROM d) GROUP BY row, word),
bw AS (SELECT word, count(*) AS c FROM (SELECT unnest({_WORDS_SQL}) AS word FROM benchmark) GROUP BY word),
hashed AS (SELECT word, {_CRC_SQL} % 10000 AS bucket FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
s AS (SELECT bucket, sum(c)::BIGINT AS s FROM dw JOIN hashed USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(c)::BIGINT AS t FROM bw JOIN hashed USING (word) GROUP BY bucket),
n AS (SELECT coalesce((SELECT sum(s) FROM s), 0)::BIGINT AS s_all, coalesce((SELECT sum(t) FROM t), 0)::BIGINT AS t_all),
gain AS (SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1) * (s_all + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * (t_all + 10000))::DOUBLE))::BIGINT AS gain
         FROM s FULL JOIN t USING (bucket), n),
weight AS (SELECT row, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM dw JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY row),
scored AS (SELECT row, doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
             (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
           FROM d LEFT JOIN weight USING (row)),
able AS (SELECT row, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, 10 * count(*) OVER () // 100 AS draw FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= draw THEN rank END AS rank FROM scored LEFT JOIN able USING (row)
""")
def op11(spark, sf_dir):
    got = importance.resample(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return got.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_fill_in_middle", """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
                  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens FROM documents),
u AS (SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(tokens) + 1) AS c1, ('0x' || substr(h, 9, 8))::BIGINT % (len(tokens) + 1) AS c2,
             ('0x' || substr(h, 17, 8))::BIGINT % 100 AS r3, ('0x' || substr(h, 25, 8))::BIGINT % 100 AS r4 FROM t),
v AS (SELECT *, array_to_string(tokens[1:least(c1, c2)], '') AS prefix, array_to_string(tokens[least(c1, c2) + 1:greatest(c1, c2)], '') AS middle,
             array_to_string(tokens[greatest(c1, c2) + 1:], '') AS suffix,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r3 >= 50 THEN 'plain'
                  WHEN r4 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256 FROM v
""")
def op12(spark, sf_dir):
    woven = infill.transform(documents(spark, sf_dir))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return infill.restore(woven).select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output"), sha("restored"))


@query("op13_quality")
def op13(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return quality.score(docs, quality.train(docs, _table(spark, sf_dir, "labels")))


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
