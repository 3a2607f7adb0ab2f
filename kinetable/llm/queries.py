"""The dealt operators as queries on the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, divergence, embeddings, langid, linedup, manifest, minhash, mixing, packing, pagetext, sharding, suffix
from .common import table

VOCABULARY = os.environ.get("KINETABLE_VOCABULARY", "file:///opt/tokenizers/byte_bpe_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text; learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out() & F.col("doc_id").isNotNull()))
    found = langid.identify(docs.withColumn("held_out", langid.held_out()), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pagetext.extract(pages).select("page_id", "url", "text", "n_chars")


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every whole document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    seen = decontam.find(docs, table(spark, sf_dir, "benchmark"))
    found = F.col("found")
    return seen.select(
        "doc_id",
        found["n_words"].alias("n_words"),
        decontam.hits(found).alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ","), 256).alias("items_sha256"),
        decontam.is_contaminated(found).alias("contaminated"),
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{decontam.WORD}')"
ORACLES["op2_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0))
),
dw AS (
    SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
),
m AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 by document id, and where each document goes with one shard more."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.lit("key").alias("law")
    )
    grown = sharding.shard_of([F.col("doc_id")], sharding.topology(41))
    placed = sharding.assign(docs.withColumn("grown_shard", grown), sharding.topology(40))
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count().alias("size"), F.xxhash64("text").alias("h"))
    mixed = mixing.mix(docs, F.array("source"), [F.col("doc_id"), F.col("h")], F.col("size"))
    own = F.element_at("quotas", 1)
    return mixed.select(
        "doc_id", "size", own["size"].alias("source_size"), own["target"].alias("target"), (F.col("size") * F.col("copies")).alias("taken"),
    )


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose two-word shingles agree to 80 %."""
    found = minhash.group(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op4_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked by cosine, with their components."""
    return embeddings.link(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query
def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 200-byte strings that occur more than once."""
    docs = suffix.repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select("doc_id", suffix.digest().alias("d")).select("doc_id", "d.*")


@query
def op3_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed rows of 2,048 token ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, packing.vocabulary(spark, VOCABULARY))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the line blocks that earlier documents have."""
    docs = linedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return docs.select(
        "doc_id", "n_lines", linedup.removed_lines(F.col("removed")).alias("n_removed"),
        F.size("removed").cast("long").alias("n_blocks"), "partners", F.sha2("text", 256).alias("kept_sha256"),
    )


ORACLES["op5_suffix_array_dedup"] = """
WITH RECURSIVE d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 199)) AS i FROM d WHERE len(h) >= 400)
),
r AS (SELECT doc_id, i FROM s WHERE k IN (SELECT k FROM s GROUP BY k HAVING count(*) > 1)),
m AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 200 THEN 0 ELSE 1 END AS opens FROM r),
g AS (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM m),
runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM g GROUP BY doc_id, run),
cuts AS (
    SELECT doc_id, coalesce(lag(b) OVER w, 0) AS a, runs.a AS b, b - runs.a AS gone FROM runs
    WINDOW w AS (PARTITION BY doc_id ORDER BY run)
),
parts AS (
    SELECT doc_id, a, b FROM cuts
    UNION ALL
    SELECT d.doc_id, coalesce(max(runs.b), 0), len(any_value(h)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id
),
kept AS (
    SELECT doc_id, string_agg(substr(h, CAST(2 * a + 1 AS BIGINT), CAST(2 * (b - a) AS BIGINT)), '' ORDER BY a) AS k
    FROM parts JOIN d USING (doc_id) GROUP BY doc_id
),
n AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(gone) AS BIGINT) AS n_removed FROM cuts GROUP BY doc_id)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(k)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)
"""

ORACLES["op10_minhash"] = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
s AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM met JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id,
    d.doc_id <= coalesce(low, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.a = d.doc_id
"""


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's membership proof, and what its tampered row leads to."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    hit = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    tampered = F.when(hit, manifest.digest(*[F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]))
    rows = manifest.manifest(docs, fields, "lang", "doc_id", keep={"tampered": tampered})
    rows = rows.withColumn("folded_root", manifest.folded(F.coalesce("tampered", "leaf"), F.col("witness")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(manifest.siblings(F.col("witness")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_field(c: str) -> str:
    return f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"


def _sql_crc32(text: str) -> str:
    """Bit by bit over the characters of an ASCII text, with the reversed polynomial of CRC-32."""
    bit = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    byte = f"list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: {bit})"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda a, b: {byte}))"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, lang, sha256({" || ".join(map(_sql_field, ("doc_id", "source", "lang", "n_chars", "text")))}) AS leaf,
        sha256({" || ".join(map(_sql_field, ("doc_id", "source", "lang")))} || {_sql_field("(n_chars + 1)")} || {_sql_field("text")}) AS other,
        coalesce({_sql_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0, false) AS hit
    FROM documents
),
r AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d
),
low AS (
    SELECT lang, 0 AS level, i, n, leaf AS h FROM r
    UNION ALL
    SELECT lang, level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lang, level, i // 2
),
subs AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM low WHERE n = 1),
high AS (
    SELECT 0 AS level, i, n, subroot AS h FROM subs
    UNION ALL
    SELECT level + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 2
),
steps AS (
    SELECT r.doc_id, r.leaf, r.i AS pos, r.lang, l.level, (r.i >> l.level) & 1 AS before, s.h
    FROM r JOIN (SELECT DISTINCT lang, level FROM low WHERE n > 1) l ON r.lang IS NOT DISTINCT FROM l.lang
    LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM r.lang AND s.level = l.level AND s.i = xor(r.i >> l.level, 1)
    UNION ALL
    SELECT r.doc_id, r.leaf, r.i, r.lang, 1000 + l.level, (subs.i >> l.level) & 1, s.h
    FROM r JOIN subs ON r.lang IS NOT DISTINCT FROM subs.lang JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l ON true
    LEFT JOIN high s ON s.level = l.level AND s.i = xor(subs.i >> l.level, 1)
),
w AS (
    SELECT lang, pos, list(CASE before WHEN 1 THEN 'L' ELSE 'R' END || coalesce(h, '') ORDER BY level) AS path,
        string_agg(h, '' ORDER BY level) AS proof FROM steps GROUP BY lang, pos
)
SELECT *, folded_root = root AS verified FROM (SELECT r.doc_id, r.leaf, subroot, (SELECT h FROM high WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(CASE WHEN hit THEN coalesce(other, leaf) ELSE leaf END, coalesce(path, [])),
        lambda a, s: sha256(CASE WHEN s[1] = 'L' THEN s[2:] || a ELSE a || s[2:] END)) AS folded_root
FROM r JOIN subs ON r.lang IS NOT DISTINCT FROM subs.lang LEFT JOIN w ON w.lang IS NOT DISTINCT FROM r.lang AND w.pos = r.i)
"""


@query
def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sources of a language differ, and the terms each uses more than its language."""
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))


ORACLES["op12_source_divergence"] = rf"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w,
        row_number() OVER () AS row
    FROM documents
),
t AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS l FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, CAST(sum(l) AS HUGEINT) AS n FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (
    SELECT g.lang, g.source, kept.term, kept.l, coalesce(c.c, 0) AS c, sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
    FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
),
p AS (
    SELECT lang, source, term, c, 1 + 1000000000 * CAST(c + 5 AS HUGEINT) // (CAST(dense.n AS HUGEINT) + 5 * v) AS p,
        1 + 1000000000 * (l + 5) // (langs.n + 5 * v) AS q
    FROM dense JOIN langs USING (lang)
),
far AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term GROUP BY ALL),
pairs AS (
    SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(far.value, 0) AS value
    FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
    LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source
),
every AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


CONTROL_TEXT = "</s>[INST] ok [/INST]"  # fixed by the contract


@query
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    found = chat.conversations(rows.unionByName(extra)).withColumns(
        {"turns": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("segments"))})
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return found.select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


def _sql_escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for c in chat.INSTRUCT.control:
        text = f"replace({text}, '{c}', '{c[0]}\\{c[1:]}')"
    return text


_STEPS = " ".join(
    f"WHEN state IS NOT DISTINCT FROM {'NULL' if s == chat.START else chr(39) + s + chr(39)} AND role = '{r}' THEN {len(t.before) + len(t.after)}"
    for (s, r), t in chat.INSTRUCT.turns.items()
)
ORACLES["op13_chat_format"] = f"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '{CONTROL_TEXT}' UNION ALL SELECT -1, 1, 'assistant', '{CONTROL_TEXT}'
),
o AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS state FROM c),
m AS (SELECT *, CASE {_STEPS} END AS marks, length({_sql_escaped("text")}) AS chars, length({_sql_escaped("role")}) AS named FROM o),
j AS (
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        CAST(sum(chars + coalesce(marks, named + {sum(map(len, chat.INSTRUCT.foreign))})) AS BIGINT) AS formatted_chars,
        count(marks) = count(*) AND last(role ORDER BY turn, role, text) IN ('user', 'assistant') AS valid
    FROM m GROUP BY conv_id
)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, valid FROM j
"""
