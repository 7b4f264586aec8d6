"""Registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.llm import bpe, covertree, digests, extraction, idcoder, langid, mixing, ppm, redirects, repair, runs, simhash, toxicity
from inkdex.llm.common import WORD_PATTERN, find_package, remainder
from inkdex.session import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    learned = labels.where(remainder(F.col("doc_id"), 5) != 0).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score(docs, toxicity.fit(docs, learned))
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return scored.select("doc_id", held_out, "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = ppm.score_texts(_table(spark, sf_dir, "documents"), ~held_out)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), *columns)


def op3_idcoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "ids")
    idcoder.write_ids(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1, out)
    found = idcoder.read_ids(spark, out, with_ids=False)
    started = found.join(idcoder.segment_starts(spark, out), ["part", "segment"])
    return started.select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op4_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = digests.compare_with_next(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        F.lower(F.hex("digest")).alias("fingerprint"),
        F.lower(F.hex("edited_digest")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


# The rules of the query, each a verdict and the start of an address.
URL_RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]


def op5_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = redirects.url_verdicts(_table(spark, sf_dir, "pages"), URL_RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    found = extraction.extract(pages, extraction.fit(pages))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents")).documents
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_covertree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    found = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), tokenizer), tokenizer)
    return found.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_classes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    found = repair.report(repair.damage(turns)).withColumnRenamed("conv_id", "own")
    ids = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("own")), "left").select(
        "conv_id",
        *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )


def op12_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    learned = remainder(F.col("doc_id"), 5) != 0
    found = langid.identify(docs, langid.fit(docs.where(learned), F.col("lang")))
    return found.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def made_periodic(docs: DataFrame) -> DataFrame:
    """(doc_id, text); every tenth document by crc32 of its id goes on in a short period from some word on."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all("text", F.lit(WORD_PATTERN), F.lit(0))
    rows = docs.select("doc_id", "text", F.when(crc % 10 == 0, words).alias("words"), F.floor(crc / 10).alias("g"))
    n = F.size("words").cast("bigint")
    rows = rows.select("doc_id", "text", "words", "g", n.alias("n"), F.when(n > 0, F.pmod("g", n)).alias("a"))
    rows = rows.select("doc_id", "text", "words", "n", "a", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    place = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1),
        lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")),
    )
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(place, " ")).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(made_periodic(_table(spark, sf_dir, "documents")))

    def strength(run):
        # Doubles tell quotients of numbers below 2**26 apart.
        return F.struct(
            (run["length"] / run["period"]).alias("exponent"), (-run["start"]).alias("s"), (-run["period"]).alias("p"), run.alias("run")
        )

    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    best = F.array_max(F.transform("runs", strength))["run"]
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    return rows.select(
        "doc_id",
        "n_runs",
        *(F.col("best")[c].alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def _ready(query: Callable) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_toxicity,
        op2_ppm,
        op3_idcoder,
        op4_digests,
        op5_redirects,
        op6_extraction,
        op7_mixing,
        op8_covertree,
        op9_bpe,
        op10_simhash,
        op11_repair,
        op12_langid,
        op13_runs,
    ]
    return {query.__name__: _ready(query) for query in named}


def _redirects_sql() -> str:
    """Labels spread along links by a recursive query; the longest rule by a sort."""
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/')[0]}', '/{r.split('/', 1)[1]}')" for v, r in URL_RULES)

    def rest(url: str) -> str:
        return f"CASE WHEN contains({url}, '://') THEN regexp_extract({url}, '(?s)^.*?://(.*)$', 1) ELSE '' END"

    def ruled(table: str, key: str) -> str:
        return f"""SELECT {key}, arg_max(rule, (length(rule), verdict = 'allow')) AS rule,
            arg_max(verdict, (length(rule), verdict = 'allow')) AS verdict
            FROM {table} JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
            GROUP BY {key}"""

    return f"""WITH RECURSIVE rules(verdict, rule, rule_host, rule_path) AS (VALUES {rules}),
    rests AS (SELECT row_number() OVER () AS id, page_id, url, html, {rest('url')} AS rest FROM pages),
    rows AS (
        SELECT id, page_id, url, html, lower(regexp_extract(rest, '^[^/?#]*')) AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
            CASE WHEN contains(url, '://') THEN lower(regexp_extract(url, '(?s)^(.*?)://', 1)) || '://'
                || lower(regexp_extract(rest, '^[^/?#]*')) || regexp_extract(rest, '(?s)^[^/?#]*([^#]*)', 1) END AS node
        FROM rests),
    tags AS (
        SELECT node, unnest(regexp_extract_all(html, '(?is)<link\\b[^>]*>')) AS tag FROM rows WHERE node IS NOT NULL),
    links AS (
        SELECT node AS a, regexp_extract(tag, '(?i)\\bhref\\s*=\\s*"([^"]*)"', 1) AS b FROM tags
        WHERE regexp_matches(tag, '(?i)\\brel\\s*=\\s*["'']?canonical')),
    edges AS (SELECT a, b FROM links WHERE contains(b, '://') UNION SELECT b, a FROM links WHERE contains(b, '://')),
    reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a),
    places AS (
        SELECT DISTINCT b AS node, lower(regexp_extract({rest('b')}, '^[^/?#]*')) AS host,
            regexp_extract({rest('b')}, '^[^/?#]*([^?#]*)', 1) AS path FROM reach),
    place_rules AS ({ruled('places', 'node')}),
    groups AS (SELECT a AS node, min(verdict) AS verdict FROM reach JOIN place_rules ON b = node GROUP BY a),
    own AS ({ruled('rows', 'id')})
    SELECT page_id, host, path, own.rule, coalesce(own.verdict, groups.verdict, 'allow') AS verdict
    FROM rows LEFT JOIN own USING (id) LEFT JOIN groups USING (node)"""


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text of ASCII characters, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ord(ch)::BIGINT)"
    bits = "list_reduce(list_prepend(xor(sum, byte), range(8)), lambda crc, i: xor(crc >> 1, (crc & 1) * 3988292384))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda sum, byte: {bits}), 4294967295::BIGINT)"


def _repair_sql() -> str:
    """Forward by turns: the cheapest, then least, edits that lead to each state, with the text they leave."""
    space = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def least(*ways: str) -> str:
        """Of (cost, audit, lines) the first; a missing one has a null cost."""
        return f"list_sort(list_filter([{', '.join(ways)}], lambda way: way.c IS NOT NULL))[1]"

    def way(state: str, cost: str, letter: str, line: str, when: str = "true") -> str:
        # Lines are joined as they come; the first of them begins with a line feed, which is cut off pos the end.
        lines = f"{state}.t || {line}" if line else f"{state}.t"
        return f"{{'c': CASE WHEN {when} THEN {state}.c + {cost} END, 'a': {state}.a || '{letter}', 't': {lines}}}"

    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    keep, rerole, own = "(3 * trunc)", "(3 + 3 * trunc)", "chr(10) || role || ':' || text"
    free = "NOT gone"

    def kept(state: str, initial: str) -> str:
        return way(state, keep, "K", own, f"{free} AND left(role, 1) = '{initial}'")

    def made(state: str, role: str) -> str:
        return way(state, rerole, "R", f"{role} || text", free)

    def deleted(state: str) -> str:
        return way(state, "4", "D", "")

    inserted_user = [way(s, "3", "I", user) for s in ("z", "s", "a")]
    nothing = "{'c': NULL::BIGINT, 'a': '', 't': ''}"
    return f"""WITH RECURSIVE named AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
    kinds AS (SELECT *, {_crc32_sql('name')} % 20 AS kind FROM named),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM kinds WHERE kind <> 0),
    placed AS (
        SELECT conv_id, turn, role, text, row_number() OVER w AS pos,
            row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
            lag(left(role, 1)) OVER w || left(role, 1) AS pair, right(rtrim(text, {space}), 1) AS last
        FROM damaged
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substring(text, 1, 256), md5(text), copy)),
    faults AS (
        SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate'
            WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
    rows AS (SELECT *, fault IN ('blank', 'duplicate') AS gone, (fault = 'truncated')::BIGINT AS trunc FROM faults),
    counts AS (
        SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
            count(*) FILTER (fault = 'truncated') AS truncated,
            count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
        FROM rows GROUP BY conv_id),
    steps AS (
        SELECT conv_id, 0::BIGINT AS pos, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS z,
            {nothing} AS s, {{'c': 3::BIGINT, 'a': 'I', 't': {user}}} AS u,
            {{'c': 6::BIGINT, 'a': 'II', 't': {user} || {assistant}}} AS a FROM counts
        UNION ALL
        SELECT conv_id, pos, z, s, u, {least('a', way('u', '3', 'I', assistant))} AS a FROM (
            SELECT conv_id, pos, z, s, a, {least('u', *inserted_user)} AS u FROM (
                SELECT conv_id, r.pos, {deleted('z')} AS z, {least(deleted('s'), kept('z', 's'))} AS s,
                    {least(deleted('u'), kept('z', 'u'), kept('s', 'u'), kept('a', 'u'), *(made(x, user) for x in ('z', 's', 'a')))} AS u,
                    {least(deleted('a'), kept('u', 'a'), made('u', assistant))} AS a
                FROM (SELECT conv_id AS own, pos AS done, z, s, u, a FROM steps) JOIN rows r
                    ON r.conv_id IS NOT DISTINCT FROM own AND r.pos = done + 1))),
    ends AS (
        SELECT steps.conv_id, {least('z', 'a')} AS best FROM steps JOIN counts
            ON steps.conv_id IS NOT DISTINCT FROM counts.conv_id AND pos = n)
    SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
        coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
        coalesce(best.a, '') AS audit, sha256(coalesce(substring(best.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) ids
    LEFT JOIN counts ON ids.conv_id IS NOT DISTINCT FROM counts.conv_id
    LEFT JOIN ends ON ids.conv_id IS NOT DISTINCT FROM ends.conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op5_redirects": _redirects_sql(), "op11_repair": _repair_sql()}
