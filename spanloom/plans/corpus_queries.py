"""Queries on dictionaries, profiles, plans, splits, decisions, decoders and the star schema."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spanloom.functions import text as t
from spanloom.operators import bio, decisions, dictionary, evaluate, neighbours, planning, profile, quality, sets, spans, tokens

from . import base
from .base import SEEDS_CTE, TAGGED, TOK, bigints, spans_cte, table

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: bigints(f(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# dictionary

# Seeds are single words, so a hit is a token whose folded form is an alias of at least 4 characters.
_HITS = f"""{SEEDS_CTE}, {TOK}, hits AS MATERIALIZED (
  SELECT t.doc_id, t.lang, s.label, t.i AS token_start, t.i + 1 AS token_stop, s.alias, t.start, t.stop FROM tok t JOIN seeds s ON lower(s.alias) = lower(t.token) WHERE length(s.alias) >= 4)"""


def _hits(spark, sf_dir):
    return dictionary.match(base.tokens(spark, sf_dir), dictionary.high_precision(base.seeds(spark)))


@query(f"WITH {_HITS} SELECT doc_id, label, token_start, token_stop, alias, 'alias_compact' AS matcher, start, stop FROM hits")
def alias_hits(spark, sf_dir):
    return _hits(spark, sf_dir)


@query(f"""WITH {TAGGED}, {spans_cte('g', 'gold')}, hits AS (SELECT t.doc_id, s.label, s.alias, t.i AS token_start, t.i + 1 AS token_stop FROM tok t JOIN seeds s ON lower(s.alias) = lower(t.token) WHERE length(s.alias) >= 4),
  j AS (SELECT h.*, g.label AS gl, abs(h.token_start - g.token_start) + abs(h.token_stop - g.token_stop) AS gap FROM hits h LEFT JOIN g ON g.doc_id = h.doc_id AND g.token_start < h.token_stop AND h.token_start < g.token_stop),
  o AS (SELECT *, CASE WHEN gl IS NULL THEN 3 WHEN gl = label AND gap = 0 THEN 0 WHEN gl = label THEN 1 ELSE 2 END AS tier FROM j QUALIFY row_number() OVER (PARTITION BY doc_id, token_start, token_stop, label ORDER BY tier, gap) = 1)
  SELECT label, alias, count(*) AS hits, count(*) FILTER (tier = 0) AS exact, count(*) FILTER (tier = 1) AS overlap, count(*) FILTER (tier = 2) AS conflict, count(*) FILTER (tier = 3) AS false_positive,
  round_even(count(*) FILTER (tier = 0) / count(*), 4) AS precision_exact, round_even(count(*) FILTER (tier <= 1) / count(*), 4) AS precision_lenient FROM o GROUP BY label, alias""")
def alias_quality(spark, sf_dir):
    gold = bio.spans(base.tagged(spark, sf_dir), "gold")
    return evaluate.alias_quality(spans.nearest(_hits(spark, sf_dir), gold))


_VERBS = ", ".join(f"'{v}'" for v in t.REPORTING)


@query(f"""WITH {_HITS}, w AS (SELECT doc_id, i, token, lag(token, 1) OVER d AS b1, lag(token, 2) OVER d AS b2, lag(token, 3) OVER d AS b3, lead(token, 1) OVER d AS a1, lead(token, 2) OVER d AS a2, lead(token, 3) OVER d AS a3
  FROM tok WINDOW d AS (PARTITION BY doc_id ORDER BY i)), c AS (SELECT h.label, coalesce(b1 = '(', false) AND (coalesce(a1 = ')', false) OR coalesce(a1 = '.' AND a2 = ')', false)) AS dispatch,
  len(list_intersect(list_transform([b3, b2, b1, token, a1, a2, a3], lambda x: lower(x)), [{_VERBS}])) > 0 AS reporting
  FROM hits h JOIN w ON w.doc_id = h.doc_id AND w.i = h.token_start) SELECT label, count(*) AS hits, count(*) FILTER (dispatch) AS dispatch, count(*) FILTER (reporting) AS reporting FROM c GROUP BY label""")
def alias_contextual(spark, sf_dir):
    rows = base.tokens(spark, sf_dir)
    hits = dictionary.match(rows, dictionary.high_precision(base.seeds(spark)))
    count = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    return dictionary.with_context(rows, hits).groupBy("label").agg(F.count("*").alias("hits"), count("dispatch"), count("reporting"))


_PERIODS = [("1-URGENT", 1993), ("2-HIGH", 1995), ("3-MEDIUM", None), ("4-NOT SPECIFIED", 1900)]


@query("""WITH p(label, active_start) AS (VALUES """ + ", ".join(f"('{a}', {b if b else 'NULL'})" for a, b in _PERIODS) + """),
  v AS (SELECT o.o_orderpriority AS label, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE year(o_orderdate) END AS y, p.label IS NOT NULL AS known, active_start FROM orders o LEFT JOIN p ON p.label = o.o_orderpriority),
  s AS (SELECT label, CASE WHEN coalesce(label, '') = '' THEN 'missing_label' WHEN NOT known THEN 'missing_entity_metadata' WHEN y IS NULL THEN 'unknown_document_date' WHEN active_start IS NULL THEN 'missing_active_start'
    WHEN y < active_start THEN 'suspicious_before_start' ELSE 'ok' END AS verification, CASE WHEN known AND y < active_start THEN y - active_start END AS delta FROM v)
  SELECT label, verification, count(*) AS n, min(delta) AS least_delta FROM s GROUP BY ALL""")
def temporal_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("label"), F.when(F.col("o_orderkey") % 17 != 0, F.year("o_orderdate")).alias("year"))
    checked = dictionary.plausible(orders, spark.createDataFrame(_PERIODS, "label string, active_start int"))
    return checked.groupBy("label", "verification").agg(F.count("*").alias("n"), F.min("delta_years").alias("least_delta"))


# profiles


_FORM = "replace(replace(translate(lower(token), 'ſµ', 'sμ'), 'ß', 'ss'), 'ŉ', 'ʼn')"
_WORDS = r"tok WHERE regexp_matches(token, '^\p{L}')"


@query(f"""WITH {TOK}, f AS (SELECT lang, {_FORM} AS form, token AS surface, doc_id * 1000000 + i AS ord FROM {_WORDS}),
  r AS (SELECT lang, form, surface, count(*) AS n, min(ord) AS first FROM f GROUP BY ALL),
  g AS (SELECT lang, form, sum(n) AS n, min(first) AS first, arg_max(surface, (n, -first)) AS display FROM r GROUP BY lang, form),
  k AS (SELECT *, sum(n) OVER (PARTITION BY lang) AS total, row_number() OVER (PARTITION BY lang ORDER BY n DESC, first, form) AS rank FROM g)
  SELECT lang, form, CAST(n AS BIGINT) AS n, round_even(CAST(n AS DOUBLE) / total, 4) AS share, display, rank FROM k WHERE rank <= 20""")
def surface_profile_topn(spark, sf_dir):
    rows = tokens.words(table(spark, sf_dir, "documents"), "doc_id", "lang").filter(F.col("token").rlike(r"^\p{L}"))
    named = rows.select("lang", t.normalised(F.col("token")).alias("form"), F.col("token").alias("surface"), (F.col("doc_id") * 1000000 + F.col("i")).alias("ord"))
    return profile.top_surfaces(named, ["lang"], 20)


@query(f"""WITH {TOK}, f AS (SELECT lang, {_FORM} AS form, token AS surface, doc_id, doc_id * 1000000 + i AS ord FROM {_WORDS}),
  r AS (SELECT lang, form, surface, count(*) AS n, min(ord) AS first FROM f GROUP BY ALL),
  e AS (SELECT lang, form, doc_id, ord FROM f QUALIFY row_number() OVER (PARTITION BY lang, form ORDER BY ord) <= 3)
  SELECT r.lang, r.form, string_agg(surface, ',' ORDER BY n DESC, first) AS forms, CAST(sum(n) AS BIGINT) AS n, any_value(x.examples) AS examples
  FROM r JOIN (SELECT lang, form, string_agg(doc_id, ',' ORDER BY ord) AS examples FROM e GROUP BY ALL) x ON x.lang = r.lang AND x.form = r.form GROUP BY r.lang, r.form""")
def surface_norm_freq(spark, sf_dir):
    rows = tokens.words(table(spark, sf_dir, "documents"), "doc_id", "lang").filter(F.col("token").rlike(r"^\p{L}"))
    named = rows.select("lang", F.col("token").alias("surface"), "doc_id", (F.col("doc_id") * 1000000 + F.col("i")).alias("ord"))
    found = profile.surface_forms(named, ["lang"], 3, t.normalised(F.col("surface")))
    return found.select("lang", "form", F.array_join("forms", ",").alias("forms"), "n", F.array_join(F.col("examples").cast("array<string>"), ",").alias("examples"))


_SPLIT = """grp AS (SELECT DISTINCT source AS grp FROM documents), ord AS (SELECT grp, row_number() OVER (ORDER BY sha1('42' || chr(9) || grp), grp) AS r, count(*) OVER () AS n FROM grp),
  split AS (SELECT grp, CASE WHEN n = 1 THEN 'train' WHEN r <= greatest(1, ceil(n * 0.15)) THEN 'test'
    WHEN r <= greatest(1, ceil(n * 0.15)) + least(greatest(1, ceil(n * 0.15)), greatest(n - greatest(1, ceil(n * 0.15)) - 1, 0)) THEN 'validation' ELSE 'train' END AS split FROM ord)"""


def _split_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.join(tokens.hinted(planning.group_split(docs.select(F.col("source").alias("grp")))), F.col("source") == F.col("grp")).drop("grp")


@query(f"WITH {_SPLIT} SELECT grp, split FROM split")
def hash_group_split(spark, sf_dir):
    return planning.group_split(table(spark, sf_dir, "documents").select(F.col("source").alias("grp")))


@query(f"""WITH {TAGGED}, {spans_cte('g', 'gold')}, {_SPLIT}, n AS (SELECT doc_id, count(*) AS n FROM tok GROUP BY doc_id), m AS (SELECT doc_id, count(*) AS m FROM g GROUP BY doc_id),
  d AS (SELECT d.*, split, coalesce(n, 0) AS n, coalesce(m, 0) AS m FROM documents d JOIN split ON grp = source LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id))
  SELECT s.split, count(d.doc_id) AS documents, count(*) FILTER (m > 0) AS annotated, CAST(coalesce(sum(n), 0) AS BIGINT) AS tokens, CAST(coalesce(sum(m), 0) AS BIGINT) AS mentions, count(DISTINCT source) AS sources,
  min('2020-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')) AS first_day, max('2020-01-' || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0')) AS last_day
  FROM (VALUES ('train'), ('validation'), ('test')) s(split) LEFT JOIN d ON d.split = s.split GROUP BY s.split""")
def split_statistics(spark, sf_dir):
    n = tokens.token_counts(table(spark, sf_dir, "documents"), "doc_id").withColumnRenamed("n", "n_tokens")
    m = bio.spans(base.tagged(spark, sf_dir), "gold").groupBy("doc_id").agg(F.count("*").alias("n_mentions"))
    day = F.concat(F.lit("2020-01-"), F.lpad((1 + F.col("doc_id") % 28).cast("string"), 2, "0"))
    docs = _split_documents(spark, sf_dir).select("doc_id", "split", "source", day.alias("date")).join(n, "doc_id", "left").join(m, "doc_id", "left").na.fill(0, ["n_tokens", "n_mentions"])
    return profile.split_statistics(docs)


@query(f"""WITH {_SPLIT} SELECT lang, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test, count(*) AS total FROM documents JOIN split ON grp = source GROUP BY lang""")
def split_by_language(spark, sf_dir):
    return profile.by_split(_split_documents(spark, sf_dir), "lang")


_COVERAGE = f"""{TAGGED}, {spans_cte('g', 'gold')}, c AS (SELECT label, lang AS language, count(*) AS total FROM g GROUP BY ALL),
  names AS (SELECT DISTINCT label FROM seeds), pend AS (SELECT label, language, count(*) AS pending FROM (SELECT 'org.ent.radiostation.epsilon' AS label, lang AS language FROM documents JOIN labels USING (doc_id) WHERE toxic = 1) GROUP BY ALL),
  grid AS MATERIALIZED (SELECT l.label, x.language, coalesce(total, 0) AS total, CASE WHEN x.language IN ('de', 'fr') THEN 2000 ELSE 500 END AS target,
    greatest(CASE WHEN x.language IN ('de', 'fr') THEN 2000 ELSE 500 END - coalesce(total, 0), 0) AS missing, coalesce(pending, 0) AS pending
    FROM names l CROSS JOIN (VALUES ('de'), ('en'), ('es'), ('fr')) x(language) LEFT JOIN c ON c.label = l.label AND c.language = x.language LEFT JOIN pend p ON p.label = l.label AND p.language = x.language)"""


def _coverage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"))
    counts = bio.spans(base.tagged(spark, sf_dir), "gold").join(docs, "doc_id").groupBy("label", "language").agg(F.count("*").alias("n"))
    waiting = docs.join(table(spark, sf_dir, "labels").filter("toxic = 1"), "doc_id").groupBy("language").agg(F.count("*").alias("n")).withColumn("label", F.lit(base.EPSILON))
    return profile.coverage(counts, base.seeds(spark), base.LANGUAGES, {"de", "fr"}, waiting, 2000, 500)


@query(f"WITH {_COVERAGE} SELECT label, language, total, CAST(target AS BIGINT) AS target, missing, pending FROM grid")
def coverage_grid(spark, sf_dir):
    return _coverage(spark, sf_dir)


@query(f"""WITH {_COVERAGE}, a AS (SELECT label, language, alias, lower(alias) AS form FROM seeds CROSS JOIN (VALUES ('de'), ('en')) x(language)),
  seen AS (SELECT label, lang AS language, lower(substr(token, 1)) AS form, count(*) AS n FROM (SELECT t.token, t.lang, s.label FROM tok t JOIN seeds s ON s.alias = t.token) GROUP BY ALL)
  SELECT g.label, g.language, a.alias AS query, g.missing, g.pending, least(100, g.missing - g.pending) AS planned_new, coalesce(seen.n, 0) AS surface_count, CASE WHEN coalesce(seen.n, 0) >= 50 THEN 60 ELSE 100 END AS priority
  FROM grid g JOIN a ON a.label = g.label AND a.language = g.language LEFT JOIN seen ON seen.label = a.label AND seen.language = a.language AND seen.form = a.form WHERE g.missing - g.pending > 0""")
def sampling_plan(spark, sf_dir):
    aliases = base.seeds(spark).select("label", F.explode(F.array(F.lit("de"), F.lit("en"))).alias("language"), F.col("alias").alias("query"))
    seen = tokens.words(table(spark, sf_dir, "documents"), "lang").join(F.broadcast(base.seeds(spark)), F.col("token") == F.col("alias")).groupBy("label", F.col("lang").alias("language"), F.lower("token").alias("form")).agg(F.count("*").alias("n"))
    rows, _ = planning.sampling_plan(_coverage(spark, sf_dir), aliases, seen, 100, 50)
    return rows


@query(f"""WITH {TAGGED}, {spans_cte('g', 'gold')}, {_SPLIT}, c AS (SELECT l.label, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test
    FROM (SELECT DISTINCT label FROM seeds) l LEFT JOIN (SELECT g.label, split FROM g JOIN documents d USING (doc_id) JOIN split ON grp = d.source) x ON x.label = l.label GROUP BY l.label),
  n AS (SELECT *, greatest(150 - validation, 0) + greatest(150 - test, 0) AS needed FROM c), p AS (SELECT *, CAST(ceil(needed * 1.5) AS BIGINT) AS planned FROM n WHERE needed > 0),
  a AS (SELECT label, alias, row_number() OVER (PARTITION BY label ORDER BY ord) AS r, count(*) OVER (PARTITION BY label) AS k FROM seeds)
  SELECT p.label, alias, r, needed, planned, CAST(greatest(0, least(ceil(planned / k), planned - ceil(planned / k) * (r - 1))) AS BIGINT) AS planned_new FROM p JOIN a USING (label) WHERE planned_new > 0""")
def holdout_gaps(spark, sf_dir):
    docs = _split_documents(spark, sf_dir).select("doc_id", "split")
    found = bio.spans(base.tagged(spark, sf_dir), "gold").join(docs, "doc_id")
    counts = base.seeds(spark).select("label").distinct().join(found.groupBy("label").agg(F.sum((F.col("split") == "validation").cast("long")).alias("validation"), F.sum((F.col("split") == "test").cast("long")).alias("test")), "label", "left").na.fill(0)
    return planning.holdout_gaps(counts, base.seeds(spark), 150)


@query(f"""WITH {_HITS}, b AS (SELECT *, row_number() OVER (PARTITION BY label, lang ORDER BY doc_id, token_start) AS turn FROM (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY label, doc_id ORDER BY token_start) = 1) QUALIFY turn <= 20),
  p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY turn, lang, doc_id, token_start) AS place FROM b) SELECT label, lang, doc_id, token_start, turn, place FROM p WHERE place <= 50""")
def balanced_selection(spark, sf_dir):
    rows = _hits(spark, sf_dir).withColumn("k", F.row_number().over(W.partitionBy("label", "doc_id").orderBy("token_start"))).filter("k = 1")
    rows = rows.join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    return planning.balanced_selection(rows, ["label", "lang"], ["doc_id", "token_start"], 20, 50).select("label", "lang", "doc_id", "token_start", "turn", "place")


@query("""WITH c AS (SELECT d.doc_id, lang, length(regexp_replace(coalesce(text, ''), '[ \\t\\n]+', ' ', 'g')) AS len FROM documents d LEFT JOIN labels l USING (doc_id) WHERE coalesce(quality, 1) = 1),
  k AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY sha1('13' || chr(9) || doc_id)) AS k FROM c WHERE len >= 200) SELECT doc_id, lang FROM k WHERE k <= 40""")
def corpus_filter_sample(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").filter("coalesce(quality, 1) = 1")
    docs = docs.filter(F.length(F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n]+", " ")) >= 200).select("doc_id", F.col("lang").alias("language"))
    targets = spark.createDataFrame([(x, 40) for x in base.LANGUAGES], "language string, target int")
    return planning.hash_sample(docs, targets, 13).select("doc_id", F.col("language").alias("lang"))


# decisions and sets

_LOG = """log AS (SELECT user_id || ':' || event_type AS review_id, event_id, ts, CASE event_type WHEN 'click' THEN 'done' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'ignored' ELSE 'todo' END AS status,
  CASE WHEN event_id % 5 = 0 THEN 'manual' WHEN event_id % 5 = 1 THEN 'gold' WHEN event_id % 7 = 0 THEN 'odd' ELSE 'prediction' END AS choice, CASE WHEN event_id % 2 = 0 THEN 'x' END AS label, event_id % 3 AS n_spans FROM events),
  last AS MATERIALIZED (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY review_id ORDER BY ts DESC, event_id DESC) = 1)"""


def decision_log(events):
    status = F.when(F.col("event_type").isin("click", "purchase"), "done").when(F.col("event_type") == "error", "ignored").otherwise("todo")
    e = F.col("event_id")
    choice = F.when(e % 5 == 0, "manual").when(e % 5 == 1, "gold").when(e % 7 == 0, "odd").otherwise("prediction")
    return events.select(F.concat_ws(":", F.col("user_id").cast("string"), "event_type").alias("review_id"), "event_id", "ts", status.alias("status"), choice.alias("choice"), F.when(e % 2 == 0, "x").alias("label"), (e % 3).alias("n_spans"))


def _latest(spark, sf_dir):
    return decisions.latest(decision_log(table(spark, sf_dir, "events")), ["review_id"], ["ts", "event_id"])


@query(f"WITH {_LOG} SELECT review_id, event_id, status, choice FROM last")
def latest_decisions(spark, sf_dir):
    return _latest(spark, sf_dir).select("review_id", "event_id", "status", "choice")


@query(f"""WITH {_LOG}, r AS (SELECT review_id, unnest([CASE WHEN status = 'todo' THEN 'undecided' END, CASE WHEN status = 'done' AND choice = 'odd' THEN 'bad_choice' END,
  CASE WHEN status = 'done' AND choice = 'manual' AND label IS NULL THEN 'label_missing' END, CASE WHEN status = 'done' AND choice = 'manual' AND n_spans = 0 THEN 'spans_missing' END]) AS rule FROM last)
  SELECT review_id, rule FROM r WHERE rule IS NOT NULL""")
def decision_validation(spark, sf_dir):
    last = _latest(spark, sf_dir)
    return decisions.validation_errors(last, last)


@query(f"""WITH {_LOG} SELECT split_part(review_id, ':', 2) AS kind, count(*) AS total, count(*) FILTER (status = 'done') AS done, count(*) FILTER (status = 'ignored') AS ignored, count(*) FILTER (status = 'todo') AS todo,
  count(*) FILTER (status NOT IN ('done', 'ignored')) AS pending FROM last GROUP BY ALL""")
def queue_summary(spark, sf_dir):
    return decisions.queue_summary(_latest(spark, sf_dir).withColumn("kind", F.split_part("review_id", F.lit(":"), F.lit(2))), "kind")


# What comes in: the judged documents with another source, and the benchmark's items under negative ids.
_INCOMING = "x AS (SELECT doc_id, lang, CASE quality WHEN 1 THEN source || '-new' ELSE source END AS source FROM documents JOIN labels USING (doc_id) UNION ALL SELECT -1 - item_id, 'xx', 'benchmark' FROM benchmark)"


def _incoming(spark, sf_dir):
    judged = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    changed = judged.select("doc_id", "lang", F.when(F.col("quality") == 1, F.concat("source", F.lit("-new"))).otherwise(F.col("source")).alias("source"))
    return changed.unionByName(table(spark, sf_dir, "benchmark").select((-1 - F.col("item_id")).alias("doc_id"), F.lit("xx").alias("lang"), F.lit("benchmark").alias("source")))


@query(f"""WITH {_INCOMING} SELECT doc_id, source, 'kept' AS change FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM x)
  UNION ALL SELECT doc_id, source, CASE WHEN doc_id IN (SELECT doc_id FROM documents) THEN 'replaced' ELSE 'added' END FROM x""")
def promote_upsert(spark, sf_dir):
    return sets.upsert(table(spark, sf_dir, "documents").select("doc_id", "source"), _incoming(spark, sf_dir).select("doc_id", "source"), "doc_id")


@query(f"""WITH {_SPLIT}, d AS (SELECT md5(coalesce(text, '')) AS k, split FROM documents JOIN split ON grp = source)
  SELECT k AS text_key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS n FROM d GROUP BY k HAVING count(DISTINCT split) > 1""")
def cross_split_duplicates(spark, sf_dir):
    return sets.cross_split(_split_documents(spark, sf_dir).select(F.md5(F.coalesce("text", F.lit(""))).alias("text_key"), "split"), "text_key")


@query(f"""WITH {_INCOMING} SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, CASE WHEN b.doc_id IS NULL THEN 'only_left' WHEN a.doc_id IS NULL THEN 'only_right' ELSE 'changed' END AS difference
  FROM (SELECT doc_id, lang, source FROM documents) a FULL JOIN x b USING (doc_id)
  WHERE a.doc_id IS NULL OR b.doc_id IS NULL OR a.source <> b.source OR a.lang IS DISTINCT FROM b.lang""")
def projection_diff(spark, sf_dir):
    return sets.differences(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), _incoming(spark, sf_dir), "doc_id", ["lang", "source"])


# decoders and vectors

LABELS = ["O", "B-X", "I-X", "B-Y", "I-Y"]


def _emissions(spark, sf_dir):
    scores = F.concat(F.transform("embedding", lambda x: x.cast("double")), F.array(F.lit(0.0)))  # 64 scores and a zero: 13 positions of 5 labels
    at = F.transform(F.sequence(F.lit(0), F.lit(12)), lambda p: F.slice(scores, p * 5 + 1, F.lit(5)))
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("doc_id"), at.alias("scores"))


_EM = """em AS MATERIALIZED (SELECT vec_id AS doc_id, CAST(p AS BIGINT) AS i, list_append(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), 0.0::DOUBLE)[p * 5 + 1:p * 5 + 5] AS s FROM embeddings, range(0, 13) t(p)),
  tags(k, tag) AS (VALUES (1, 'O'), (2, 'B-X'), (3, 'I-X'), (4, 'B-Y'), (5, 'I-Y')),
  moves AS MATERIALIZED (SELECT a.k AS f, b.k AS t FROM tags a, tags b WHERE CASE WHEN b.tag LIKE 'I-%' THEN a.tag <> 'O' AND substr(a.tag, 3) = substr(b.tag, 3) WHEN b.tag LIKE 'B-%' THEN a.tag = 'O' OR substr(a.tag, 3) <> substr(b.tag, 3) ELSE true END)"""
_ARG = "argmax AS (SELECT doc_id, i, list_extract(['O', 'B-X', 'I-X', 'B-Y', 'I-Y'], list_position(s, list_max(s))) AS tag FROM em)"
_VIT = """step(doc_id, i, k, score, path) AS (
  SELECT doc_id, i, k, s[k], [k] FROM em, tags WHERE i = 0 AND tag NOT LIKE 'I-%'
  UNION ALL
  SELECT doc_id, i, t, score, path FROM (SELECT e.doc_id, e.i, m.t, p.score + e.s[m.t] AS score, list_append(p.path, m.t) AS path, row_number() OVER (PARTITION BY e.doc_id, m.t ORDER BY p.score DESC, m.f) AS rn
    FROM step p JOIN em e ON e.doc_id = p.doc_id AND e.i = p.i + 1 JOIN moves m ON m.f = p.k) WHERE rn = 1
), best AS (SELECT doc_id, path FROM step WHERE i = 12 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, k) = 1),
viterbi AS (SELECT doc_id, CAST(generate_subscripts(path, 1) - 1 AS BIGINT) AS i, list_extract(['O', 'B-X', 'I-X', 'B-Y', 'I-Y'], unnest(path)) AS tag FROM best)"""


def _viterbi(spark, sf_dir):
    return evaluate.viterbi_decode(_emissions(spark, sf_dir), LABELS).select("doc_id", F.posexplode("tags").alias("i", "tag"))


def _argmax(spark, sf_dir):
    rows = _emissions(spark, sf_dir).select("doc_id", F.posexplode("scores").alias("i", "scores"))
    return evaluate.argmax_decode(rows, LABELS).select("doc_id", "i", "tag")


@query(f"WITH {_EM}, {_ARG} SELECT * FROM argmax")
def argmax_decode(spark, sf_dir):
    return _argmax(spark, sf_dir)


@query(f"WITH RECURSIVE {_EM}, {_VIT} SELECT * FROM viterbi")
def viterbi_decode(spark, sf_dir):
    return _viterbi(spark, sf_dir)


@query(f"WITH RECURSIVE {_EM}, {_ARG}, {_VIT} SELECT a.tag AS argmax, v.tag AS viterbi, count(*) AS n FROM argmax a JOIN viterbi v USING (doc_id, i) WHERE a.tag <> v.tag GROUP BY ALL")
def decoder_changes(spark, sf_dir):
    both = _argmax(spark, sf_dir).withColumnRenamed("tag", "argmax").join(_viterbi(spark, sf_dir).withColumnRenamed("tag", "viterbi"), ["doc_id", "i"])
    return both.filter("argmax <> viterbi").groupBy("argmax", "viterbi").agg(F.count("*").alias("n"))


@query("""WITH q AS (SELECT vec_id AS q, embedding AS e FROM embeddings WHERE vec_id % 100 = 0), s AS (
  SELECT q, v.vec_id, round(list_cosine_similarity(CAST(q.e AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])), 6) AS sim FROM q, embeddings v WHERE v.vec_id <> q)
  SELECT q, vec_id, sim FROM s QUALIFY row_number() OVER (PARTITION BY q ORDER BY sim DESC, vec_id) <= 5""")
def cosine_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.filter("vec_id % 100 = 0").select(F.col("vec_id").alias("q"), F.col("embedding").alias("e"))  # a stated query set
    return neighbours.nearest_vectors(vectors, asked, 5)


# runs of experiments, here derived from orders: a cell is a priority, a seed a month, its value the share of finished orders

_RUNS = """runs AS (SELECT o_orderpriority AS cell, month(o_orderdate) AS seed, CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) / count(*) AS value FROM orders GROUP BY ALL)"""


def _runs(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("cell"), F.month("o_orderdate").alias("seed")).agg((F.sum((F.col("o_orderstatus") == "F").cast("long")) / F.count("*")).alias("value"))


@query(f"WITH {_RUNS} SELECT cell, count(*) AS n, round(avg(value), 9) AS mean, round(coalesce(stddev_samp(value), 0.0), 9) AS stdev, min(value) AS low, max(value) AS high FROM runs GROUP BY cell")
def run_aggregate(spark, sf_dir):
    return evaluate.run_aggregate(_runs(spark, sf_dir), "cell").withColumn("mean", F.round("mean", 9)).withColumn("stdev", F.round("stdev", 9))


@query(f"""WITH {_RUNS}, d AS (SELECT r.cell, r.seed, r.value - b.value AS delta FROM runs r JOIN runs b ON b.seed = r.seed AND b.cell = '1-URGENT' WHERE r.cell <> '1-URGENT')
  SELECT cell, seed, round(delta, 9) AS delta FROM d UNION ALL SELECT cell, NULL, round(avg(delta), 9) FROM d GROUP BY cell""")
def paired_deltas(spark, sf_dir):
    return evaluate.paired_deltas(_runs(spark, sf_dir), "1-URGENT").withColumn("delta", F.round("delta", 9))


# pages, conversations, benchmark


@query(r"""SELECT page_id, length(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS n_chars,
  md5(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS digest FROM pages""")
def html_strip(spark, sf_dir):
    plain = t.strip_tags(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", F.length(plain).alias("n_chars"), F.md5(plain).alias("digest"))


@query(r"""SELECT page_id, split_part(url, '#', 1) AS base_id, regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '/\d+$', '') AS issue FROM pages""")
def url_issue_id(spark, sf_dir):
    base_id = t.base_document_id(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", base_id.alias("base_id"), F.regexp_replace(F.substring_index(base_id, "?", 1), r"/\d+$", "").alias("issue"))


@query("""WITH b AS (SELECT *, CASE WHEN role = lag(role) OVER (PARTITION BY conv_id ORDER BY turn) THEN 0 ELSE 1 END AS b FROM conversations),
  i AS (SELECT *, sum(b) OVER (PARTITION BY conv_id ORDER BY turn) AS isl FROM b) SELECT conv_id, CAST(isl AS BIGINT) AS island, any_value(role) AS role, CAST(min(turn) AS BIGINT) AS first_turn, CAST(max(turn) AS BIGINT) AS last_turn, count(*) AS turns FROM i GROUP BY conv_id, isl""")
def conversation_turn_islands(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("i"), "role")
    changed = ~F.coalesce(F.lag("role").over(tokens.by_document()) == F.col("role"), F.lit(False))
    return tokens.islands(rows, changed).groupBy(F.col("doc_id").alias("conv_id"), "island").agg(F.first("role").alias("role"), F.min("i").alias("first_turn"), F.max("i").alias("last_turn"), F.count("*").alias("turns"))


@query(f"""WITH {TOK}, b AS (SELECT item_id, regexp_extract_all(lower(text), '[a-zà-ÿ]+') AS w FROM benchmark), bg AS (SELECT DISTINCT array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT w, unnest(range(1, len(w) - 3)) AS i FROM b)),
  dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-zà-ÿ]+') AS w FROM documents), dg AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM dw))
  SELECT doc_id, count(*) AS hits, count(DISTINCT g) AS grams FROM dg WHERE g IN (SELECT g FROM bg) GROUP BY doc_id""")
def benchmark_overlap(spark, sf_dir):
    def grams(df, *keep):
        w = F.regexp_extract_all(F.lower("text"), F.lit("[a-zà-ÿ]+"), F.lit(0))
        rows = df.select(*keep, w.alias("w")).filter("size(w) >= 5").select(*keep, "w", F.explode(F.sequence(F.lit(1), F.size("w") - 4)).alias("i"))
        return rows.select(*keep, F.array_join(F.slice("w", F.col("i"), F.lit(5)), " ").alias("g"))

    wanted = grams(table(spark, sf_dir, "benchmark")).distinct()
    hits = grams(table(spark, sf_dir, "documents"), "doc_id").join(wanted, "g", "left_semi")
    return hits.groupBy("doc_id").agg(F.count("*").alias("hits"), F.count_distinct("g").alias("grams"))


# the ordinary surface


@query("""SELECT n_name, year(o_orderdate) AS y, count(*) AS orders, round(sum(o_totalprice), 2) AS revenue FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ROLLUP (n_name, year(o_orderdate))""")
def star_join_rollup(spark, sf_dir):
    orders, customer, nation = (table(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_name", F.year("o_orderdate").alias("y"), "o_totalprice")
    return rows.rollup("n_name", "y").agg(F.count("*").alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue"))


@query("""SELECT event_type, hour(ts) // 6 AS quarter, count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE ts IS NOT NULL GROUP BY ALL""")
def range_join(spark, sf_dir):
    low = table(spark, sf_dir, "events").select("event_type", "user_id", F.hour("ts").alias("h"))
    bands = spark.createDataFrame([(k, 6 * k, 6 * k + 6) for k in range(4)], "quarter long, low int, high int")
    return low.join(F.broadcast(bands), F.expr("h >= low and h < high")).groupBy("event_type", "quarter").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""SELECT 'semi' AS side, count(*) AS n FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'anti', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def semi_anti(spark, sf_dir):
    customer, keys = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    count = lambda how, name: customer.join(keys, "c_custkey", how).agg(F.lit(name).alias("side"), F.count("*").alias("n"))
    return count("left_semi", "semi").unionByName(count("left_anti", "anti"))


@query("SELECT o_custkey, o_orderkey, rank FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def topk_window(spark, sf_dir):
    at = W.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey")
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.row_number().over(at).alias("rank")).filter("rank <= 3")


@query("""WITH n AS (SELECT doc_id, len(regexp_split_to_array(trim(regexp_replace(text, '[ \\t\\n]+', ' ', 'g')), ' ')) AS n FROM documents), c AS (SELECT doc_id, n, list_distinct(list_append(range(0, greatest(n - 200, 0) + 1, 100), greatest(n - 200, 0))) AS s FROM n)
  SELECT doc_id, CAST(len(s) AS BIGINT) AS chunks, CAST(list_sum(s) AS BIGINT) AS starts FROM c""")
def word_chunks(spark, sf_dir):
    n = F.size(F.split(F.trim(F.regexp_replace("text", r"[ \t\n]+", " ")), " "))
    starts = tokens.chunks(n, 200, 0.5)
    return table(spark, sf_dir, "documents").select("doc_id", F.size(starts).alias("chunks"), F.aggregate(starts, F.lit(0).cast("long"), lambda s, x: s + x).alias("starts"))


@query(f"""WITH {TOK}, n AS (SELECT doc_id, count(*) AS n, sum(length(token) * (i + 1)) AS s FROM tok GROUP BY doc_id) SELECT count(*) AS documents, 0 AS faults FROM n""")
def canonical_tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    faults = quality.tokenisation_faults(docs, tokens.tokenise(docs)).agg(F.count("*").alias("faults"))
    return tokens.tokenise(docs).agg(F.count_distinct("doc_id").alias("documents")).crossJoin(faults)
