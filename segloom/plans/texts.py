"""Queries over texts, chats, pages and reviews."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from segloom.functions.text import TOKENIZERS, gram_hashes, ngrams, opening, sentence_count, token_count, tokens
from segloom.operators.windows import first_of
from segloom.plans.registry import query
from segloom.sources.tables import dealt, table


def documents(spark, root):
    return dealt(table(spark, root, "documents"), "doc_id")


def _count(kind):
    return f"len(regexp_extract_all(lower(text), '{TOKENIZERS[kind].replace(chr(39), chr(39) * 2)}'))"


@query("text_word_stats", f"WITH w AS (SELECT lang, {_count('plain')} AS n FROM documents) SELECT lang, count(*) AS docs, min(n) AS shortest, max(n) AS longest, CAST(sum(n) AS BIGINT) / count(*)::DOUBLE AS mean_words, count(*) FILTER (WHERE n BETWEEN 55 AND 150) AS in_range FROM w GROUP BY lang")
def text_word_stats(spark, root):
    """AGG-09, STR-01."""
    rows = documents(spark, root).select("lang", token_count(F.col("text"), "plain").alias("n"))
    return rows.groupBy("lang").agg(F.count("*").alias("docs"), F.min("n").alias("shortest"), F.max("n").alias("longest"), (F.sum("n") / F.count("*")).alias("mean_words"), F.count_if(F.col("n").between(55, 150)).alias("in_range"))


@query("tokenizer_counts", f"SELECT doc_id, {_count('blank')} AS blank, {_count('word')} AS word, {_count('plain')} AS plain, {_count('strict')} AS strict FROM documents")
def tokenizer_counts(spark, root):
    """STR-01: the four tokenizers side by side."""
    return documents(spark, root).select("doc_id", *[token_count(F.col("text"), k).cast("long").alias(k) for k in TOKENIZERS])


@query("sentence_distribution", r"WITH s AS (SELECT len(regexp_extract_all(regexp_replace(text, '\s+$', ''), '[.!?]\s+')) + 1 AS sentences FROM documents) SELECT sentences, count(*) AS docs FROM s GROUP BY sentences")
def sentence_distribution(spark, root):
    """AGG-09, STR-02."""
    return documents(spark, root).groupBy(sentence_count(F.col("text")).cast("long").alias("sentences")).agg(F.count("*").alias("docs"))


@query("text_duplicates_sha256", "SELECT sha256(text) AS digest, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def text_duplicates_sha256(spark, root):
    """AGG-08."""
    return documents(spark, root).groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


OPEN = "op AS (SELECT doc_id, lang, array_to_string(regexp_extract_all(lower(text), '[a-z0-9'']+')[1:8], ' ') AS opening FROM documents)"


@query("opening_prefix_diversity", f"WITH {OPEN}, c AS (SELECT opening, count(*) AS n FROM op GROUP BY opening) SELECT CAST(sum(n) AS BIGINT) AS docs, count(*) AS openings, max(n) AS most, count(*) >= least(sum(n), greatest(10000, sum(n) // 10)) AS diverse, max(n) <= ceil(0.02 * sum(n)) AS level FROM c")
def opening_prefix_diversity(spark, root):
    """AGG-07, UDF-05."""
    c = documents(spark, root).groupBy(opening(F.col("text")).alias("opening")).agg(F.count("*").alias("n"))
    total = F.sum("n")
    return c.agg(total.alias("docs"), F.count("*").alias("openings"), F.max("n").alias("most"), (F.count("*") >= F.least(total, F.greatest(F.lit(10000), F.floor(total / 10)))).alias("diverse"), (F.max("n") <= F.ceil(F.lit(0.02) * total)).alias("level"))


@query("normalized_openings_topn", r"""WITH n AS (SELECT lang, regexp_replace(regexp_replace(regexp_replace(lower(substr(text, 1, 40)), '[^a-z ]+', ' ', 'g'), '\b(the|a|an)\b', 'x', 'g'), ' +', ' ', 'g') AS opening FROM documents), c AS (SELECT lang, opening, count(*) AS n FROM n GROUP BY ALL)
  SELECT lang, opening, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, opening) AS k FROM c) WHERE k <= 5""")
def normalized_openings_topn(spark, root):
    """AGG-14, STR-03, TOP-01: ties go by text."""
    text = F.lower(F.substring("text", 1, 40))
    for pattern, to in ((r"[^a-z ]+", " "), (r"\b(the|a|an)\b", "x"), (r" +", " ")):
        text = F.regexp_replace(text, pattern, to)
    c = documents(spark, root).groupBy("lang", text.alias("opening")).agg(F.count("*").alias("n"))
    ranked = c.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "opening")))
    return ranked.where("k <= 5").drop("k")


@query("repetitive_openings", f"WITH {OPEN}, c AS (SELECT opening FROM op GROUP BY opening HAVING count(*) > 3) SELECT doc_id, opening FROM op WHERE opening IN (SELECT opening FROM c)")
def repetitive_openings(spark, root):
    """ROW-13: documents whose opening is over-represented, to be written anew."""
    rows = documents(spark, root).select("doc_id", opening(F.col("text")).alias("opening"))
    return rows.join(rows.groupBy("opening").agg(F.count("*").alias("n")).where("n > 3"), "opening", "left_semi").select("doc_id", "opening")


RULES = {"contact": r"[a-z0-9._]+@[a-z0-9.]+", "license": r"license|rights reserved", "shouting": r"!!", "digits": r"[0-9]{6,}", "repeat": r"\bthe the\b"}


@query("forbidden_phrase_gate", "WITH g AS (SELECT doc_id, unnest([CASE WHEN n < 55 THEN 'too_short' END, CASE WHEN n > 150 THEN 'too_long' END, " + ", ".join(f"CASE WHEN regexp_matches(lower(text), '{p}') THEN '{k}' END" for k, p in RULES.items()) + f"]) AS issue FROM (SELECT doc_id, text, {_count('plain')} AS n FROM documents)) SELECT issue, count(*) AS docs, list(doc_id ORDER BY doc_id)[1:5] AS examples FROM g WHERE issue IS NOT NULL GROUP BY issue")
def forbidden_phrase_gate(spark, root):
    """FLT-15, AGG-11: length and pattern rules, with the first five documents of each."""
    n = token_count(F.col("text"), "plain")
    issues = F.array(F.when(n < 55, "too_short"), F.when(n > 150, "too_long"), *[F.when(F.lower("text").rlike(p), k) for k, p in RULES.items()])
    rows = documents(spark, root).select("doc_id", F.explode_outer(F.filter(issues, lambda c: c.isNotNull())).alias("issue")).where("issue is not null")
    return first_of(rows, "issue", "doc_id")


PHRASES = ("of the", "and the", "in the", "de la", "der ", "que ", "the ")


@query("phrase_counts", "SELECT lang, " + ", ".join(f"CAST(sum(len(regexp_extract_all(lower(text), '{p}'))) AS BIGINT) AS p{i}" for i, p in enumerate(PHRASES)) + ", count(*) FILTER (WHERE lower(text) LIKE '%of the%') AS docs_p0 FROM documents GROUP BY lang")
def phrase_counts(spark, root):
    """STR-13, AGG-10."""
    counts = [F.sum(F.regexp_count(F.lower("text"), F.lit(p))).alias(f"p{i}") for i, p in enumerate(PHRASES)]
    return documents(spark, root).groupBy("lang").agg(*counts, F.count_if(F.contains(F.lower("text"), F.lit(PHRASES[0]))).alias("docs_p0"))


@query("ngram_contamination", r"""WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents), b AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM benchmark),
  dg AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram FROM d),
  bg AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS gram FROM b),
  dn AS (SELECT doc_id, count(*) AS n FROM dg GROUP BY 1), bn AS (SELECT item_id, count(*) AS m FROM bg GROUP BY 1), s AS (SELECT doc_id, item_id, count(*) AS shared FROM dg JOIN bg USING (gram) GROUP BY ALL)
  SELECT doc_id, item_id, shared, shared / least(n, m)::DOUBLE AS overlap FROM s JOIN dn USING (doc_id) JOIN bn USING (item_id) WHERE 2 * shared >= least(n, m)""")
def ngram_contamination(spark, root):
    """STR-04: shared word 4-grams over those of the shorter text; half or more. Hashes of grams are joined, so no text meets all others
    and no gram is moved as text; pairs that pass are counted anew on the grams themselves."""
    def side(name, key, n):
        return dealt(table(spark, root, name), key).select(F.col(key), tokens(F.col("text"), "strict").alias(f"w_{key}")).select(key, f"w_{key}", gram_hashes(F.col(f"w_{key}")).alias("g")).withColumn(n, F.size("g"))

    d, b = side("documents", "doc_id", "n"), side("benchmark", "item_id", "m")
    # The outer form, as for the inner one a filter on the arrays would be inferred, which computes them twice, and once in the scan's few tasks.
    shared = d.select("doc_id", "n", F.explode_outer("g").alias("gram")).join(b.select("item_id", "m", F.explode_outer("g").alias("gram")), "gram").groupBy("doc_id", "n", "item_id", "m").agg(F.count("*").alias("s"))
    pairs = shared.where(2 * F.col("s") >= F.least("n", "m")).select("doc_id", "item_id")
    words = pairs.join(d.select("doc_id", "w_doc_id"), "doc_id").join(b.select("item_id", "w_item_id"), "item_id")
    exact = words.select("doc_id", "item_id", ngrams(F.col("w_doc_id")).alias("a"), ngrams(F.col("w_item_id")).alias("b"))
    rows = exact.select("doc_id", "item_id", F.size(F.array_intersect("a", "b")).cast("long").alias("shared"), F.least(F.size("a"), F.size("b")).alias("of"))
    return rows.where(2 * F.col("shared") >= F.col("of")).select("doc_id", "item_id", "shared", (F.col("shared") / F.col("of")).alias("overlap"))


@query("lexical_similarity")
def lexical_similarity(spark, root):
    """STR-05: matching-block ratio of the tokens of each chat turn and the one before, in Arrow batches."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, (x or "").lower().split(), (y or "").lower().split(), autojunk=False).ratio() for x, y in zip(a, b, strict=True)])

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = table(spark, root, "conversations").withColumn("before", F.lag("text").over(w)).where("before is not null")
    return turns.select("conv_id", "turn", ratio("before", "text").alias("similarity"))


@query("chat_shape_violations", """WITH c AS (SELECT *, row_number() OVER w AS k, lag(role) OVER w AS p FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
  v AS (SELECT conv_id, unnest([CASE WHEN k = 1 AND role NOT IN ('system', 'user') THEN 'first_role' END, CASE WHEN role = p THEN 'same_role' END, CASE WHEN turn <> k - 1 THEN 'turn_index' END, CASE WHEN coalesce(trim(text), '') = '' THEN 'empty' END, CASE WHEN role = 'system' AND k > 1 THEN 'late_system' END]) AS code FROM c)
  SELECT code, count(*) AS n, count(DISTINCT conv_id) AS conversations FROM v WHERE code IS NOT NULL GROUP BY code""")
def chat_shape_violations(spark, root):
    """FLT-14."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, root, "conversations").withColumn("k", F.row_number().over(w)).withColumn("p", F.lag("role").over(w))
    role, k = F.col("role"), F.col("k")
    codes = F.array(F.when((k == 1) & ~role.isin("system", "user"), "first_role"), F.when(role == F.col("p"), "same_role"), F.when(F.col("turn") != k - 1, "turn_index"), F.when(F.coalesce(F.trim("text"), F.lit("")) == "", "empty"), F.when((role == "system") & (k > 1), "late_system"))
    return c.select("conv_id", F.explode(F.filter(codes, lambda x: x.isNotNull())).alias("code")).groupBy("code").agg(F.count("*").alias("n"), F.countDistinct("conv_id").alias("conversations"))


@query("role_sequences", "SELECT roles, count(*) AS conversations FROM (SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS roles FROM conversations GROUP BY conv_id) GROUP BY roles")
def role_sequences(spark, root):
    """FLT-14, AGG-12."""
    chats = table(spark, root, "conversations").groupBy("conv_id").agg(F.array_join(F.sort_array(F.collect_list(F.struct("turn", "role")))["role"], ">").alias("roles"))
    return chats.groupBy("roles").agg(F.count("*").alias("conversations"))


@query("envelope_split", r"""WITH m AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 1 THEN '<think>' || text || '</think>' || chr(10) || '{"turn":' || turn || '}' ELSE text END AS message FROM conversations),
  s AS (SELECT conv_id, turn, regexp_matches(message, '(?s)^<think>.*</think>\s*\{.*\}$') AS ok, message FROM m)
  SELECT conv_id, turn, ok, CASE WHEN ok THEN sha256(regexp_extract(message, '(?s)^<think>(.*)</think>\s*(\{.*\})$', 1)) END AS body, CASE WHEN ok THEN regexp_extract(message, '(?s)^<think>(.*)</think>\s*(\{.*\})$', 2) END AS target FROM s""")
def envelope_split(spark, root):
    """STR-08: reasoning and target of a reply, both or neither; the reasoning by its digest."""
    text = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("<think>"), "text", F.lit('</think>\n{"turn":'), F.col("turn").cast("string"), F.lit("}"))).otherwise(F.col("text"))
    rows = table(spark, root, "conversations").select("conv_id", "turn", text.alias("m"))
    pattern = r"(?s)^<think>(.*)</think>\s*(\{.*\})$"
    ok = F.col("m").rlike(pattern)
    return rows.select("conv_id", "turn", ok.alias("ok"), F.when(ok, F.sha2(F.regexp_extract("m", pattern, 1), 256)).alias("body"), F.when(ok, F.regexp_extract("m", pattern, 2)).alias("target"))


@query("action_pair_parse", """WITH p AS (SELECT 'left:' || l_returnflag || ', right:' || l_linestatus AS v FROM lineitem), k AS (SELECT list_transform(string_split(v, ', '), lambda x: string_split(x, ':')) AS kv FROM p)
  SELECT kv[1][2] AS "left", kv[2][2] AS "right", count(*) AS n FROM k GROUP BY ALL""")
def action_pair_parse(spark, root):
    """STR-06."""
    verb = table(spark, root, "lineitem").select(F.str_to_map(F.concat(F.lit("left:"), "l_returnflag", F.lit(", right:"), "l_linestatus"), F.lit(", "), F.lit(":")).alias("m"))
    return verb.groupBy(F.col("m")["left"].alias("left"), F.col("m")["right"].alias("right")).agg(F.count("*").alias("n"))


# The clause for each action of one arm.
CLAUSES = {"A": "open the gripper", "N": "hold still", "R": "close the gripper", "F": "move", "O": "hold still"}


def _clause(column):
    return "CASE " + column + " " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLAUSES.items()) + " END"


@query("canonical_subtask", f"""WITH c AS (SELECT {_clause('l_returnflag')} AS a, {_clause('l_linestatus')} AS b FROM lineitem), s AS (SELECT CASE WHEN a = b THEN 'both arms ' || a ELSE 'left arm: ' || a || '; right arm: ' || b END AS t FROM c)
  SELECT upper(t[1]) || t[2:] || '.' AS subtask, count(*) AS n FROM s GROUP BY 1""")
def canonical_subtask(spark, root):
    """STR-07, SEG-17."""
    words = F.create_map(*[F.lit(x) for kv in CLAUSES.items() for x in kv])
    a, b = words[F.col("l_returnflag")], words[F.col("l_linestatus")]
    t = F.when(a == b, F.concat(F.lit("both arms "), a)).otherwise(F.concat(F.lit("left arm: "), a, F.lit("; right arm: "), b))
    rows = table(spark, root, "lineitem").select(t.alias("t"))
    return rows.groupBy(F.concat(F.upper(F.substring("t", 1, 1)), F.expr("substring(t, 2)"), F.lit(".")).alias("subtask")).agg(F.count("*").alias("n"))


@query("review_decisions_default", "SELECT source, CASE WHEN l.quality IS NULL THEN 'no_clear_issue' WHEN l.quality = 0 THEN 'confirmed' WHEN toxic = 1 THEN 'uncertain' ELSE 'clear' END AS decision, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY ALL")
def review_decisions_default(spark, root):
    """JOIN-11, AGG-16."""
    joined = documents(spark, root).select("doc_id", "source").join(table(spark, root, "labels"), "doc_id", "left")
    decision = F.when(F.col("quality").isNull(), "no_clear_issue").when(F.col("quality") == 0, "confirmed").when(F.col("toxic") == 1, "uncertain").otherwise("clear")
    return joined.groupBy("source", decision.alias("decision")).agg(F.count("*").alias("n"))


@query("review_orphans", "SELECT count(*) AS orphans FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE n_chars > 500)")
def review_orphans(spark, root):
    """JOIN-11, SET-04: reviews of documents that are not there."""
    docs = documents(spark, root).where("n_chars > 500").select("doc_id")
    return table(spark, root, "labels").join(docs, "doc_id", "left_anti").agg(F.count("*").alias("orphans"))


@query("issue_matrix", "SELECT source, count(*) AS reviewed, count(*) FILTER (WHERE quality = 0) AS confirmed, count(*) FILTER (WHERE toxic = 1) AS toxic, 100.0::DOUBLE * count(*) FILTER (WHERE quality = 0) / count(*) AS confirmed_percent FROM labels JOIN documents USING (doc_id) GROUP BY source")
def issue_matrix(spark, root):
    """AGG-15, AGG-17, AGG-18."""
    rows = table(spark, root, "labels").join(documents(spark, root).select("doc_id", "source"), "doc_id")
    bad = F.count_if(F.col("quality") == 0)
    return rows.groupBy("source").agg(F.count("*").alias("reviewed"), bad.alias("confirmed"), F.count_if(F.col("toxic") == 1).alias("toxic"), (F.lit(100.0) * bad / F.count("*")).alias("confirmed_percent"))


@query("key_coverage", "SELECT (SELECT count(*) FROM (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)) AS missing, (SELECT count(*) FROM (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents)) AS unexpected, (SELECT count(*) FROM (SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents)) AS common")
def key_coverage(spark, root):
    """SET-02, SET-03: one full join counts all three sets."""
    a = documents(spark, root).select("doc_id", F.lit(1).alias("a")).distinct()
    b = table(spark, root, "labels").select("doc_id", F.lit(1).alias("b")).distinct()
    return a.join(b, "doc_id", "full").agg(F.count_if(F.col("b").isNull()).alias("missing"), F.count_if(F.col("a").isNull()).alias("unexpected"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("common"))


@query("judgment_normalize", "SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END), ''), nullif(CASE WHEN doc_id % 5 = 0 THEN '' ELSE source END, ''), 'none') AS reasoning, coalesce(quality, -1) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def judgment_normalize(spark, root):
    """ROW-20: the first field that says something, and defaults."""
    rows = documents(spark, root).select("doc_id", "lang", "source").join(table(spark, root, "labels").select("doc_id", "quality"), "doc_id", "left")
    first = F.nullif(F.trim(F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("lang"))), F.lit(""))
    second = F.nullif(F.when(F.col("doc_id") % 5 == 0, "").otherwise(F.col("source")), F.lit(""))
    return rows.select("doc_id", F.coalesce(first, second, F.lit("none")).alias("reasoning"), F.coalesce("quality", F.lit(-1)).alias("quality"))


@query("final_sentence", r"WITH f AS (SELECT doc_id, regexp_extract(regexp_replace(text, '\s+$', ''), '([^.!?\n]*[.!?])$', 1) AS last_, text FROM documents) SELECT doc_id, last_ <> '' AS closed, length(last_) AS n_chars FROM f")
def final_sentence(spark, root):
    """ROW-19: whether a text ends with a finished sentence, and its length; read from the end, where the pattern is anchored."""
    last = F.regexp_extract(F.regexp_replace(F.reverse("text"), r"^\s+", ""), r"^([.!?][^.!?\n]*)", 1)
    return documents(spark, root).select("doc_id", (last != "").alias("closed"), F.length(last).cast("long").alias("n_chars"))


@query("safe_component", r"SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '^_+|_+$', '', 'g') AS name FROM pages")
def safe_component(spark, root):
    """STR-12."""
    return table(spark, root, "pages").select("page_id", F.regexp_replace(F.regexp_replace(F.lower("url"), r"[^a-z0-9]+", "_"), r"^_+|_+$", "").alias("name"))


@query("endpoint_list", r"SELECT regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, count(*) AS pages, min(page_id) AS first_page, count(*) FILTER (WHERE url LIKE 'https%') AS secure FROM pages GROUP BY 1")
def endpoint_list(spark, root):
    """SRC-20: hosts in the order they first come."""
    host = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    return table(spark, root, "pages").groupBy(host.alias("host")).agg(F.count("*").alias("pages"), F.min("page_id").alias("first_page"), F.count_if(F.col("url").startswith("https")).alias("secure"))


@query("instruction_arm", r"SELECT CASE WHEN regexp_matches(lower(text), '\band\b') AND NOT regexp_matches(lower(text), '\bof\b') THEN 'left' WHEN regexp_matches(lower(text), '\bof\b') AND NOT regexp_matches(lower(text), '\band\b') THEN 'right' END AS arm, count(*) AS n FROM conversations GROUP BY 1")
def instruction_arm(spark, root):
    """STR-14: exactly one of two words."""
    a, b = (F.lower("text").rlike(rf"\b{w}\b") for w in ("and", "of"))
    return table(spark, root, "conversations").groupBy(F.when(a & ~b, "left").when(b & ~a, "right").alias("arm")).agg(F.count("*").alias("n"))


@query("required_terms", "SELECT conv_id, turn, len(list_filter(['the', 'and', 'to', 'que', 'die'], lambda t: contains(lower(text), t))) AS found FROM conversations WHERE len(list_filter(['the', 'and', 'to', 'que', 'die'], lambda t: contains(lower(text), t))) = 0")
def required_terms(spark, root):
    """STR-15, FLT-18: turns that hold none of the terms asked for."""
    terms = F.array(*[F.lit(t) for t in ("the", "and", "to", "que", "die")])
    found = F.size(F.filter(terms, lambda t: F.contains(F.lower("text"), t)))
    return table(spark, root, "conversations").select("conv_id", "turn", found.cast("long").alias("found")).where("found = 0")


@query("prompt_assembly", "SELECT conv_id, turn, concat_ws(chr(10), 'Turn: ' || turn, 'Role: ' || role, CASE WHEN turn > 0 THEN 'Previous: ' || lag(role) OVER (PARTITION BY conv_id ORDER BY turn) END, 'Length: ' || length(text)) AS prompt FROM conversations")
def prompt_assembly(spark, root):
    """STR-17, ROW-02: lines that only stand where there is something to say."""
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    lines = [F.concat(F.lit("Turn: "), F.col("turn").cast("string")), F.concat(F.lit("Role: "), "role"), F.when(F.col("turn") > 0, F.concat(F.lit("Previous: "), before)), F.concat(F.lit("Length: "), F.length("text").cast("string"))]
    return table(spark, root, "conversations").select("conv_id", "turn", F.concat_ws("\n", *lines).alias("prompt"))
