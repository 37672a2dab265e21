"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode
from .conversation_repair import ENDS, audit_conversations
from .exact_dedup import exact_dedup
from .license_scan import PHRASES, key_place, license_scan, template_words
from .license_texts import LICENSES
from .near_dedup import near_duplicates
from .ordinal_quality import graded, rate_quality
from .packing import pack
from .quality_rules import BUCKETS, GRAM, THRESHOLD, quality_rules
from .ranked_search import SEPARATORS, ranked_search
from .secrets import KINDS, scan_secrets
from .simhash import simhash_duplicates
from .suffix_dedup import suffix_dedup
from .toxicity import score_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graded(table(spark, sf_dir, "labels"), F.col("quality"), F.col("toxic"))


def op1_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_quality(table(spark, sf_dir, "documents"), ratings(spark, sf_dir))


def op2_shortest_pack_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op3_secret_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    counts = {f"n_{k}": F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long") for k in KINDS}  # noqa: B023
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))
    return found.select("doc_id", *(c.alias(n) for n, c in counts.items()), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe_encode(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe_decode(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1")).drop("mean_log_ratio")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_conversations(table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ordinal_quality, op2_shortest_pack_first, op3_secret_structure, op4_suffix_dedup, op5_exact_dedup,
        op6_toxicity, op7_bpe, op8_quality_rules, op9_license_scan, op10_dart_minhash,
        op11_ranked_search, op12_conversation_repair, op13_simhash,
    )}


def _license_sql() -> str:
    """The scan in SQL: key phrases by comparison word for word, then the template's words in place around each."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def places(phrase: list[str]) -> str:
        rest = " AND ".join(f"coalesce(w[i + {n}] = '{x}', false)" for n, x in enumerate(phrase))
        return f"list_filter(range(1, len(w) + 1), lambda i: {rest})"

    base = [f"{places(p.split())} AS b{n}" for n, (p, _) in enumerate(PHRASES)]
    shares = []
    for t, (_, template, key) in enumerate(LICENSES):
        words = template_words(template)
        off = key_place(words, key.split())
        listed = "[" + ", ".join(f"'{w}'" for w in words) + "]"
        in_place = f"len(list_filter(range(1, {len(words) + 1}), lambda j: i - {off} + j >= 2 AND coalesce(w[i - {off} + j - 1] = {listed}[j], false)))"
        shares.append(f"list_transform({places(key.split())}, lambda i: {in_place} / {len(words)}) AS s{t}")
    labels = [f"CASE WHEN len(b{n}) > 0 THEN '{label}' END" for n, (_, label) in enumerate(PHRASES)]
    more = [f"CASE WHEN len(s{t}) > 0 THEN '{label}' END" for t, (label, _, _) in enumerate(LICENSES)]
    joined = lambda of: f"coalesce(array_to_string(list_sort(list_distinct(list_filter([{', '.join(of)}], lambda x: x IS NOT NULL))), ','), '')"
    every = "list_concat(" + ", list_concat(".join(f"b{n}" for n in range(len(PHRASES) - 1)) + f", b{len(PHRASES) - 1}" + ")" * (len(PHRASES) - 1)
    best = "greatest(" + ", ".join(f"coalesce(list_max(s{t}), 0)" for t in range(len(LICENSES))) + ")"
    return rf"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
             f AS (SELECT doc_id, w, {", ".join(base)}, {", ".join(shares)} FROM d),
             g AS (SELECT *, {every} AS found FROM f)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(found) AS BIGINT) AS n_base, CAST(list_min(found) - 1 AS BIGINT) AS first_word,
               CAST(list_max(found) - 1 AS BIGINT) AS last_word, {joined(labels)} AS base_labels, {joined(labels + more)} AS labels,
               CAST(CASE WHEN len(found) > 0 THEN 1 ELSE {best} END AS DOUBLE) AS score
        FROM g"""


def _rules_sql() -> str:
    """The counts, and the mean log ratio over hashed 4-grams; hashes are worked out once for each distinct gram."""
    byte = lambda k: f"(instr('0123456789ABCDEF', g[{2 * k + 1}]) - 1) * 16 + instr('0123456789ABCDEF', g[{2 * k + 2}])"  # noqa: E731  (the byte and 1)
    power = lambda k: pow(0x9E3779B97F4A7C15, k, 1 << 64)
    whole = " + ".join(f"CAST({byte(k)} AS UHUGEINT) * {power(k)}" for k in range(GRAM))
    low = lambda x: f"CAST(({x}) % 18446744073709551616::UHUGEINT AS UBIGINT)"
    return rf"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
                              list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
                       FROM documents WHERE doc_id IS NOT NULL),
                 part AS (SELECT doc_id, unnest(range(0, greatest(len(w) - 2, 0))) AS i, w FROM d),
                 three AS (SELECT doc_id, i, w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] AS s FROM part),
                 twice AS (SELECT doc_id, i FROM three QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
                 repeated AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM twice) GROUP BY doc_id),
                 hexed AS (SELECT doc_id, hex(encode(t)) AS raw FROM d),
                 cut AS (SELECT doc_id, raw, unnest(range(0, greatest(length(raw) // 2 - {GRAM - 1}, 0), 200)) AS base FROM hexed),
                 piece AS (SELECT doc_id, substr(raw, 2 * base + 1, {2 * (200 + GRAM - 1)}) AS raw FROM cut),
                 gram AS (SELECT doc_id, substr(raw, 2 * i + 1, {2 * GRAM}) AS g, count(*) AS n
                          FROM (SELECT doc_id, raw, unnest(range(0, length(raw) // 2 - {GRAM - 1})) AS i FROM piece) GROUP BY ALL),
                 h0 AS (SELECT g, {low(whole)} AS x FROM (SELECT DISTINCT g FROM gram)),
                 h1 AS (SELECT g, {low("CAST(xor(x, x >> 30) AS UHUGEINT) * 13787848793156543929")} AS x FROM h0),
                 h2 AS (SELECT g, {low("CAST(xor(x, x >> 27) AS UHUGEINT) * 10723151780598845931")} AS x FROM h1),
                 bucket AS (SELECT g, xor(x, x >> 31) % {BUCKETS} AS bucket FROM h2),
                 counted AS (SELECT doc_id, bucket, sum(n) AS n FROM gram JOIN bucket USING (g) GROUP BY ALL),
                 trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1),
                 both_sums AS (SELECT bucket, sum(n) AS raw, sum(CASE WHEN t.doc_id IS NOT NULL THEN n ELSE 0 END) AS target
                               FROM counted LEFT JOIN trusted t USING (doc_id) GROUP BY bucket),
                 share AS (SELECT bucket, ln((target + 1) / ((SELECT sum(target) FROM both_sums) + {BUCKETS}))
                                          - ln((raw + 1) / ((SELECT sum(raw) FROM both_sums) + {BUCKETS})) AS ratio FROM both_sums),
                 score AS (SELECT doc_id, sum(n * ratio) / sum(n) AS mean FROM counted JOIN share USING (bucket) GROUP BY doc_id),
                 base AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
                                 CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                                 CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                                 list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
                                 CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words, coalesce(mean, 0) AS mean
                          FROM d LEFT JOIN repeated r USING (doc_id) LEFT JOIN score s USING (doc_id)),
                 judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
            SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, n_repeat_words,
                   base_failed, NOT base_failed AND mean >= {THRESHOLD} AS kept
            FROM judged"""


def _search_sql() -> str:
    """Every document's whole score for every item, then the best."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[{SEPARATORS.decode()}]+'), lambda x: x <> '')"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, {terms} AS w FROM documents),
             total AS (SELECT count(*) AS docs, sum(len(w)) AS occurrences FROM d WHERE len(w) > 0),
             asked AS (SELECT item, item_id, t, count(*) AS repeats FROM (
                           SELECT item, item_id, unnest(w) AS t FROM (SELECT row_number() OVER () AS item, item_id, {terms} AS w FROM benchmark)) GROUP BY ALL),
             posting AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY ALL),
             weight AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM posting CROSS JOIN total GROUP BY t, docs),
             long AS (SELECT r, doc_id, 75 + CAST((25 * len(w) * docs) // occurrences AS BIGINT) AS m FROM d CROSS JOIN total),
             score AS (SELECT item, item_id, r, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS score
                       FROM asked JOIN weight USING (t) JOIN posting USING (t) JOIN long USING (r) GROUP BY ALL HAVING score > 0),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score)
        SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 20"""


def _conversation_sql() -> str:
    """Damage, and the cheapest edits from every row on, last row first, each state with its cost, letters and messages."""
    at = lambda c, a, m: f"{{'c': {c}, 'a': {a}, 'm': {m}}}"
    more = lambda x, cost, letter, line: at(f"{x}.c + {cost}", f"'{letter}' || {x}.a", f"list_prepend({line}, {x}.m)" if line else f"{x}.m")
    line = "r.role || ':' || r.text"
    goes = {"n": ("u", "user"), "s": ("u", "user"), "u": ("a", "assistant"), "a": ("u", "user")}
    kept = {"n": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    rows = []
    for state, (to, role) in goes.items():
        ways = [more(f"v.{state}", 3, "D", None), f"CASE WHEN NOT r.must THEN {more(f'v.{to}', '2 + r.cut', 'R', f"'{role}:' || r.text")} END"]
        ways += [f"CASE WHEN NOT r.must AND r.initial = '{first}' THEN {more(f'v.{onto}', 'r.cut', 'K', line)} END" for first, onto in kept[state].items()]
        rows.append(f"list_min([{', '.join(ways)}]) AS {state}")
    user, both = more("u", 2, "I", "'user:'"), at("a.c + 4", "'II' || a.a", "list_concat(['user:', 'assistant:'], a.m)")
    closed = {"n": f"[n, {user}, {both}]", "s": f"[s, {user}, {both}]", "u": f"[u, {more('a', 2, 'I', chr(39) + 'assistant:' + chr(39))}]", "a": f"[a, {user}]"}
    none = "CAST([] AS VARCHAR[])"
    return f"""
        WITH RECURSIVE byte AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
             raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
             kind AS (SELECT raw.*, xor(list_reduce(list_concat([4294967295], list_transform(string_split(k, ''), lambda x: CAST(ascii(x) AS BIGINT))),
                             lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM raw CROSS JOIN byte),
             hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                             CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '{ENDS}', '') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS nth
                      FROM kind WHERE kind <> 0),
             placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), nth) AS i,
                               right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS final FROM hurt),
             judged AS (SELECT *, left(role, 1) AS initial, final = '' AS blank, final <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS twice FROM placed),
             rows_ AS (SELECT *, blank OR twice AS must, CAST(NOT blank AND NOT twice AND final NOT IN ('.', '!', '?') AS INT) AS cut,
                              CAST(coalesce(lag(initial) OVER w || initial NOT IN ('su', 'ua', 'au'), false) AS INT) AS odd FROM judged WINDOW w AS (PARTITION BY conv_id ORDER BY i)),
             told AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CAST(blank AS INT)) AS blank,
                             sum(CAST(twice AS INT)) AS twice, sum(cut) AS cut, sum(odd) AS odd FROM rows_ GROUP BY conv_id),
             way AS (SELECT conv_id, n + 1 AS i, {at("CAST(0 AS BIGINT)", "''", none)} AS n, {at("CAST(4 AS BIGINT)", "'II'", "['user:', 'assistant:']")} AS s,
                            {at("CAST(2 AS BIGINT)", "'I'", "['assistant:']")} AS u, {at("CAST(0 AS BIGINT)", "''", none)} AS a FROM told
                     UNION ALL
                     SELECT conv_id, i, {", ".join(f"list_min({x}) AS {c}" for c, x in closed.items())}
                     FROM (SELECT r.conv_id, r.i, {", ".join(rows)} FROM way v JOIN rows_ r ON r.conv_id IS NOT DISTINCT FROM v.conv_id AND r.i = v.i - 1))
        SELECT c.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(twice, 0) AS BIGINT) AS duplicate,
               CAST(coalesce(cut, 0) AS BIGINT) AS truncated, CAST(coalesce(odd, 0) AS BIGINT) AS illegal, CAST(coalesce(w.n.c, 0) AS BIGINT) AS cost,
               coalesce(w.n.a, '') AS audit, sha256(coalesce(array_to_string(w.n.m, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN told t ON t.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN way w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = 1"""


def oracle_sql() -> dict[str, str]:
    return {
        "op12_conversation_repair": _conversation_sql(),
        "op11_ranked_search": _search_sql(),
        "op9_license_scan": _license_sql(),
        "op8_quality_rules": _rules_sql(),
        "op4_suffix_dedup": r"""
            WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS raw FROM documents WHERE doc_id IS NOT NULL),
                 part AS (SELECT doc_id, unnest(range(0, greatest(length(raw) // 2 - 99, 0), 200)) AS base, raw FROM d),
                 piece AS (SELECT doc_id, base, substr(raw, 2 * base + 1, 598) AS raw FROM part),
                 win AS (SELECT doc_id, base + i AS start, md5(substr(raw, 2 * i + 1, 200)) AS w
                         FROM (SELECT doc_id, base, raw, unnest(range(0, length(raw) // 2 - 99)) AS i FROM piece)),
                 gone AS (SELECT doc_id, start FROM win QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, start) > 1),
                 step AS (SELECT doc_id, start, lag(start) OVER (PARTITION BY doc_id ORDER BY start) AS before FROM gone),
                 run AS (SELECT doc_id, start, sum(CASE WHEN before IS NULL OR start > before + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY start) AS nth FROM step),
                 span AS (SELECT doc_id, nth, min(start) AS a, max(start) + 100 AS b FROM run GROUP BY ALL),
                 held AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY doc_id),
                 cut AS (SELECT d.doc_id, d.raw, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
                                list_append(coalesce(a, []), length(d.raw) // 2) AS stop, list_prepend(0, coalesce(b, [])) AS start
                         FROM d LEFT JOIN held USING (doc_id))
            SELECT doc_id, CAST(length(raw) // 2 AS BIGINT) AS n_bytes, CAST(n_removed AS BIGINT) AS n_removed, CAST(n_spans AS BIGINT) AS n_spans,
                   sha256(unhex(array_to_string(list_transform(range(1, len(stop) + 1), lambda i: substr(raw, 2 * start[i] + 1, 2 * (stop[i] - start[i]))), ''))) AS kept_sha256
            FROM cut""",
        # every pair, no signatures: a pair that no band brings together would show
        "op10_dart_minhash": r"""
            WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents WHERE doc_id IS NOT NULL),
                 place AS (SELECT doc_id, w, unnest(range(1, CASE WHEN len(w) >= 5 THEN len(w) - 3 WHEN len(w) > 0 THEN 2 ELSE 1 END)) AS i FROM d),
                 shingle AS (SELECT doc_id, md5(array_to_string(w[i : i + 4], ' ')) AS s, 1 + floor(log2(count(*))) AS weight FROM place GROUP BY ALL),
                 size AS (SELECT doc_id, sum(weight) AS weight, count(*) AS n FROM shingle GROUP BY doc_id),
                 pair AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.weight, b.weight)) AS weight, count(*) AS n
                          FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
                 link AS (SELECT a, b FROM pair p JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
                          WHERE p.weight >= 0.8 * (x.weight + y.weight - p.weight) OR p.n >= 0.8 * (x.n + y.n - p.n)),
                 both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
                 reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
            SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM reach GROUP BY a""",
        "op5_exact_dedup": r"""
            WITH d AS (
                SELECT doc_id, coalesce(text, '') AS t,
                       regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
                FROM documents)
            SELECT doc_id,
                   first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size,
                   doc_id IS NOT DISTINCT FROM first_value(doc_id) OVER w AND length(t) = first_value(length(t)) OVER w AS kept,
                   sha256(body) AS text_sha256
            FROM d
            WINDOW w AS (PARTITION BY body ORDER BY length(t) DESC, doc_id
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
    }
