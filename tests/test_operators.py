"""Span operators on small literal cases and against plain Python."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanloom.functions import text as t
from spanloom.operators import bio, decisions, dictionary, edits, evaluate, planning, profile, quality, sets, spans, tokens
from spanloom.plans import catalogue
from spanloom.sources import files
from spanloom.streaming import decisions as stream

LABELS = ["O", "B-X", "I-X", "B-Y", "I-Y"]


def tagged(spark, *docs):
    return spark.createDataFrame([(d, i, f"t{i}", 3 * i, 3 * i + 2, tag) for d, tags in enumerate(docs) for i, tag in enumerate(tags)], "doc_id long, i int, token string, start int, stop int, tag string")


def as_spans(spark, *rows):
    return spark.createDataFrame(list(rows), "doc_id long, token_start int, token_stop int, label string")


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect())) if columns else sorted(map(tuple, df.collect()))


SPAN = ["doc_id", "token_start", "token_stop", "label"]


def test_tokens_tile_the_text(spark):
    texts = ["A.F.P. said: 12,5 % (x_y)…", "", None, " \n ", "Ünïcødé ½ ² 日本 á", "one"]
    rows = tokens.tokenise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["i"])
        assert [r["i"] for r in mine] == list(range(len(mine)))
        assert all(text[r["start"] : r["stop"]] == r["token"] for r in mine)
        assert "".join(r["token"] for r in mine) == re.sub(r"\s", "", text or "")
    assert [r["token"] for r in sorted(rows, key=lambda r: r["i"]) if r["doc_id"] == 0][:6] == ["A", ".", "F", ".", "P", "."]


def test_windows_and_chunks(spark):
    n = spark.createDataFrame([(0, 0), (1, 5), (2, 10), (3, 11)], "doc_id long, n int")
    assert tuples(tokens.windows(n, 6, 2)) == [(1, 0, 0, 5), (2, 0, 0, 6), (2, 1, 4, 10), (3, 0, 0, 6), (3, 1, 4, 10), (3, 2, 8, 11)]
    got = spark.createDataFrame([(7,), (4,), (0,), (8,)], "n int").select("n", tokens.chunks(F.col("n"), 4, 0.5).alias("s")).collect()
    assert {r["n"]: list(r["s"]) for r in got} == {7: [0, 2, 3], 4: [0], 0: [], 8: [0, 2, 4]}
    assert tuples(tokens.first_window(tokens.windows(n, 6, 2)).filter("doc_id = 2")) == [(2, i, int(i >= 6)) for i in range(10)]


def decode(tags, merge=False):
    out, now = [], None
    for i, tag in enumerate([*tags, "O"]):
        label = None if tag == "O" else tag[2:]
        if now and (label != now[1] or (tag.startswith("B-") and not merge)):
            out.append((now[0], i, now[1]))
            now = None
        if label and not now:
            now = (i, label)
    return out


@pytest.mark.parametrize("merge", [False, True])
def test_spans_equal_a_loop_and_tags_come_back(spark, merge):
    rng = random.Random(8)
    docs = [[rng.choice(LABELS) for _ in range(rng.randint(1, 12))] for _ in range(60)]
    rows = tagged(spark, *docs)
    found = bio.spans(rows, merge_adjacent=merge)
    assert tuples(found, *SPAN) == sorted((d, a, b, x) for d, tags in enumerate(docs) for a, b, x in decode(tags, merge))
    if not merge:
        again = bio.spans(bio.tags(rows.drop("tag"), found.select(*SPAN)))
        assert tuples(again, *SPAN) == tuples(found, *SPAN)
    outside = bio.spans(tagged(spark, ["I-X", "I-X", "O", "B-Y", "I-X"]), on_malformed="outside")
    assert tuples(outside, *SPAN) == [(0, 3, 4, "Y")]
    with pytest.raises(Exception, match="malformed"):
        bio.spans(tagged(spark, ["I-X"]), on_malformed="error").collect()


def test_violations_and_label_maps(spark):
    rows = tagged(spark, ["I-X", "O", "I-Y", "B-X", "I-Y", "??", "I-X", "I-X"])
    assert [r[-1] for r in tuples(bio.violations(rows))] == ["sequence_start_to_I", "O_to_I", "different_label_to_I", "malformed_previous_to_I"]
    ids = {r["tag"]: r["id"] for r in bio.label_map(tagged(spark, ["I-Y", "B-X"]), "tag", both=True).collect()}
    assert ids == {"O": 0, "B-X": 1, "I-X": 2, "B-Y": 3, "I-Y": 4}
    bad = spark.createDataFrame([("B-X", 1), ("I-X", 3), ("B-Y", 3)], "tag string, id long")
    assert {r["fault"] for r in bio.check_label_map(bad).collect()} == {"repeated_id", "not_contiguous", "not_one_O", "unpaired"}
    with pytest.raises(Exception, match="overlapping"):
        bio.tags(tagged(spark, ["O"] * 4), as_spans(spark, (0, 0, 2, "X"), (0, 1, 3, "Y"))).collect()


def test_import_policies(spark):
    seeds = spark.createDataFrame([("x", "pub.x", True), ("n", None, False)], "id string, label string, trainable boolean")
    got = bio.import_tags(tagged(spark, ["I-X", "I-x", "B-unk", "I-unk", "I-X", "B-n", "B-q", "O"]), seeds).orderBy("i").collect()
    assert [r["tag"] for r in got] == ["B-pub.x", "I-pub.x", "O", "O", "B-pub.x", "O", "O", "O"]
    assert [r["reason"] for r in got] == [None, None, "unknown_agency", "unknown_agency", None, "non_trainable_label", "unknown_label", None]
    assert [r["repaired"] for r in got] == [True, False, False, False, True, False, False, False]


def test_alignment_outcomes(spark):
    gold = as_spans(spark, (0, 0, 2, "a"), (1, 0, 2, "a"), (2, 0, 2, "a"), (3, 0, 1, "a"), (4, 0, 2, "a"), (4, 2, 4, "a"), (5, 0, 2, "a"))
    pred = as_spans(spark, (0, 0, 2, "a"), (1, 0, 2, "b"), (2, 0, 3, "a"), (3, 1, 2, "a"), (4, 1, 3, "b"), (5, 1, 3, "b"))
    got = spans.aligned(gold, pred)
    assert tuples(got, "doc_id", "outcome") == [(0, "correct"), (1, "wrong_label"), (2, "span_mismatch"), (3, "extra"), (3, "missed"), (4, "complex_overlap"), (5, "wrong_label_and_span")]
    by = {r["label"]: r.asDict() for r in evaluate.outcomes_by_label(got, ["correct", "missed", "complex_overlap"]).collect()}
    assert by["a"]["complex_overlap"] == 2 and by["a"]["missed"] == 1
    assert spans.disagreements(gold, pred).count() == 6 and spans.disagreements(gold, gold).count() == 0


def test_greedy_equals_a_loop(spark):
    rng = random.Random(9)
    rows = {(d, a, a + rng.randint(1, 5), rng.choice("ab")) for d in range(40) for a in (rng.randint(0, 25) for _ in range(rng.randint(1, 12)))}
    rows = [(*r, rng.choice([0.5, 0.9]), rng.choice([0.1, 0.2])) for r in sorted(rows)]
    want = []
    for d in range(40):
        kept = []
        for r in sorted((x for x in rows if x[0] == d), key=lambda x: (x[1] - x[2], -x[4], -x[5], x[1], x[3], x[2])):
            if not any(k[1] < r[2] and r[1] < k[2] for k in kept):
                kept.append(r)
        want += kept
    got = spans.greedy(spark.createDataFrame(rows, "doc_id long, token_start int, token_stop int, label string, confidence double, margin double"))
    assert tuples(got, *SPAN) == sorted(r[:4] for r in want)


def test_alias_rules(spark):
    texts = ["The A . F . P . said", "Havas-Reuter and (Havas)", "Agence Havas.", "havas, HAVAS x Havas", "A F P"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    aliases = dictionary.seeds_from(spark, [("l.afp", "A.F.P.", 0), ("l.havas", "Havas", 0), ("l.havas", "Agence Havas", 1)])
    got = dictionary.match(tokens.tokenise(docs), aliases)
    found = {(r["doc_id"], texts[r["doc_id"]][r["start"] : r["stop"]], r["matcher"]) for r in got.collect()}
    assert (0, "A . F . P .", "alias_compact") in found and (2, "Agence Havas", "alias_compact") in found
    assert (1, "Havas", "alias_compact") in found and (1, "Havas-Reuter", "alias_hyphenated_suffix") in found
    assert not any("," in s or "(" in s or s == "Havas." for _, s, _ in found)
    assert {r["alias"] for r in dictionary.high_precision(dictionary.seeds_from(spark, [("a", "AFP", 0), ("a", "A.F", 1), ("a", "Havas", 2)])).collect()} == {"A.F", "Havas"}
    near = dictionary.contextual(tokens.tokenise(docs), got)
    assert {(r["doc_id"], r["dispatch"], r["reporting"]) for r in near.collect()} == {(0, False, True), (1, True, False)}


def test_context_of_long_aliases(spark):
    texts = [f"{a}( {'w ' * n}{b}" for n in (1, 11, 12, 13, 40) for a, b in (("", ") x"), ("x ", "x x reported"), ("", "x x x reported"))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cut = tokens.tokenise(docs)
    where = {i: [r["i"] for r in cut.filter(f"doc_id = {i}").collect() if r["token"] == "w"] for i in range(len(texts))}
    hits = spark.createDataFrame([(i, "l", min(w), max(w) + 1) for i, w in where.items()], "doc_id long, label string, token_start int, token_stop int")
    got = {(r["doc_id"], r["dispatch"], r["reporting"]) for r in dictionary.contextual(cut, hits).collect()}
    assert got == {x for k in range(0, len(texts), 3) for x in ((k, True, False), (k + 1, False, True))}
    assert dictionary.contextual(cut, hits.limit(0)).count() == 0


def test_plausibility_priorities(spark):
    periods = spark.createDataFrame([("a", 1900), ("b", None)], "label string, active_start int")
    rows = spark.createDataFrame([("a", 1890), ("a", 1950), ("a", None), ("b", 1950), ("c", 1950), (None, 1950)], "label string, year int")
    got = [(r["verification"], r["delta_years"]) for r in dictionary.plausible(rows, periods).collect()]
    assert sorted(got, key=str) == sorted([("suspicious_before_start", -10), ("ok", None), ("unknown_document_date", None), ("missing_active_start", None), ("missing_entity_metadata", None), ("missing_label", None)], key=str)


def test_metrics_golden_values(spark):
    gold = as_spans(spark, *[(0, 2 * i, 2 * i + 1, "a") for i in range(612)])
    pred = as_spans(spark, *[(0, 2 * i, 2 * i + 1, "a") for i in range(529)], *[(1, 2 * i, 2 * i + 1, "a") for i in range(37)])
    r = evaluate.entity_metrics(gold, pred).first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.9346289752650176, 0.8643790849673203, 0.8981324278438031)
    none = evaluate.entity_metrics(gold.limit(0), pred.limit(0)).first()
    assert (none["correct"], none["f1"]) == (0, 0.0)
    runs = spark.createDataFrame([("4", 17, 0.9), ("4", 42, 0.8), ("8", 17, 0.7), ("8", 42, 0.9)], "cell string, seed int, value double")
    deltas = {r["seed"]: round(r["delta"], 9) for r in evaluate.paired_deltas(runs, "4").collect()}
    assert deltas == {17: -0.2, 42: 0.1, None: -0.05}
    assert evaluate.run_aggregate(runs.limit(1), "cell").first()["stdev"] == 0.0


def test_viterbi_equals_search(spark):
    rng = np.random.default_rng(10)
    import itertools

    docs = []
    for d in range(60):
        s = rng.integers(-3, 1, (rng.integers(1, 5), 5)).astype(float)
        docs.append((d, s.tolist()))
        paths = [p for p in itertools.product(range(5), repeat=len(s)) if all(evaluate.allowed(LABELS[a] if a is not None else None, LABELS[b]) for a, b in zip([None, *p], p, strict=False))]
        best = max(sum(s[i, k] for i, k in enumerate(p)) for p in paths)
        mine = evaluate.viterbi(s, LABELS)
        assert tuple(mine) in paths and sum(s[i, k] for i, k in enumerate(mine)) == best
    got = evaluate.viterbi_decode(spark.createDataFrame([*docs, (99, [])], "doc_id long, scores array<array<double>>"), LABELS).collect()
    assert {r["doc_id"]: list(r["tags"]) for r in got}[99] == [] and len(got) == 61


def test_subtoken_patterns(spark):
    cases = {"all_O": ["O", "O"], "mixed_entity_types": ["B-X", "I-Y"], "first_O_continuation_entity": ["O", "I-X"], "internal_O": ["B-X", "O", "I-X"], "valid_B": ["B-X", "I-X"], "valid_I": ["I-X"], "invalid_bio_shape": ["B-X", "B-X"]}
    rows = spark.createDataFrame(list(cases.items()), "name string, tags array<string>").select("name", evaluate.expansion_pattern(F.col("tags")).alias("p")).collect()
    assert all(r["name"] == r["p"] for r in rows)


def test_splits_and_draws(spark):
    groups = [f"g{i}" for i in range(20)]
    got = dict(tuples(planning.group_split(spark.createDataFrame([(g,) for g in groups], "grp string"))))
    order = sorted(groups, key=lambda g: hashlib.sha1(f"42\t{g}".encode()).hexdigest())
    assert [got[g] for g in order] == ["test"] * 3 + ["validation"] * 3 + ["train"] * 14
    assert tuples(planning.group_split(spark.createDataFrame([("a",)], "grp string"))) == [("a", "train")]
    assert planning.water_fill({"a": 100, "b": 3, "c": 0}, 50) == {"a": 47, "b": 3, "c": 0} and sum(planning.water_fill({"a": 5, "b": 5, "c": 5}, 2).values()) == 2
    benefit = spark.createDataFrame([("g1", "x", 5), ("g2", "x", 1), ("g2", "y", 4), ("g3", "y", 9)], "grp string, label string, n int")
    split = dict(tuples(planning.deficit_split(benefit, 4)))
    assert sorted(k for k, v in split.items() if v == "test") and len(split) == 3
    rng = random.Random(3)
    counts = {f"g{i}": {label: rng.randint(1, 6) for label in "uvwxyz" if rng.random() < 0.4} for i in range(60)}
    table = spark.createDataFrame([(g, label, n) for g, c in counts.items() for label, n in c.items()], "grp string, label string, n int")
    digest = lambda g: hashlib.sha1(f"42\t{g}".encode()).hexdigest()
    want: dict = {}
    for name in ("test", "validation"):
        lack = dict.fromkeys("uvwxyz", 12)
        while True:
            gain = [(-sum(min(lack[k], n) for k, n in c.items()), digest(g), g) for g, c in counts.items() if g not in want]
            if min(gain)[0] == 0:
                break
            best = min(gain)[2]
            want[best] = name
            for k, n in counts[best].items():
                lack[k] = max(0, lack[k] - n)
    for frontier in (3, 1000):
        assert {k: v for k, v in tuples(planning.deficit_split(table, 12, frontier=frontier)) if v} == want
    rows = spark.createDataFrame([("l", "de", f"i{k % 3}", k) for k in range(9)] + [("l", "fr", f"j{k}", k) for k in range(3)], "label string, lang string, issue string, k int")
    drawn = planning.balanced_selection_by_issue(rows, ["label", "lang"], ["k"], 2, 5).collect()
    assert sorted((r["lang"], r["issue"]) for r in drawn) == [("de", "i0"), ("de", "i1"), ("fr", "j0"), ("fr", "j1")]


def test_decisions_fold_and_replay(spark, tmp_path):
    schema = "review_id string, at int, n int, status string"
    log = [("a", 1, 1, "done"), ("a", 3, 2, "todo"), ("b", 2, 3, "done"), ("a", 2, 4, "ignored"), ("b", 2, 5, "todo")]
    want = [("a", 3, 2, "todo"), ("b", 2, 5, "todo")]
    assert tuples(decisions.latest(spark.createDataFrame(log, schema), ["review_id"], ["at", "n"])) == want
    keys, order, state = ["review_id"], ["at", "n"], "file://" + str(tmp_path / "state")
    for rows in (log[4:], log[3:4], log[:1], log[1:2], log[2:3]):  # late ones among them
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        stream.keep_latest(stream.read_log(spark, str(tmp_path / "log"), schema, 1), state, str(tmp_path / "check"), keys, order, 2).awaitTermination()
    assert tuples(stream.read_latest(spark, state, keys, order)) == want
    assert sorted(p.name[:6] for p in (tmp_path / "state").iterdir()) == ["batch=", "batch=", "batch=", "state=", "state="]
    base = as_spans(spark, (0, 0, 2, "a"), (0, 4, 6, "b"))
    patches = spark.createDataFrame([(0, "r1", "2", "accept", 1, 3, "c"), (0, "r2", "1", "accept", 4, 6, "O"), (0, "r3", "3", "reject", 8, 9, "c"), (1, "r4", "1", "modify", 0, 1, "d")], "doc_id long, review_id string, reviewed_at string, choice string, token_start int, token_stop int, label string")
    once = decisions.apply_patches(base, patches)
    assert tuples(once) == [(0, 1, 3, "c", "replaced"), (1, 0, 1, "d", "added")]
    assert {r["change"] for r in decisions.apply_patches(once.drop("change"), patches).collect()} == {"kept"}
    span = "array<struct<token_start:int,token_stop:int,label:string>>"
    choices = spark.createDataFrame([(0, 0, "prediction", None, [(0, 2, "a")], [(0, 3, "z")]), (0, 1, "neither", None, [(4, 6, "b")], [])], f"doc_id long, ord int, choice string, correct_label string, gold {span}, predicted {span}")
    assert tuples(decisions.apply_choices(base, choices)) == [(0, 0, 3, "z")]


def test_sets_and_faults(spark):
    rows = spark.createDataFrame([(1, "train", "train", 0), (1, "test", "test", 1), (2, "test", "train", 2), (2, "test", "test", 3)], "k long, split string, own string, ord int")
    assert tuples(sets.cross_split(rows, "k"), "k", "splits") == [(1, "test,train")]
    assert tuples(sets.kept_of_duplicates(rows, "k", "train"), "k", "ord") == [(1, 0), (2, 3)]
    docs = spark.createDataFrame([(0, "ab cd")], "doc_id long, text string")
    toks = spark.createDataFrame([(0, 0, "ab", 0, 2, "B-X"), (0, 1, "xx", 3, 5, "O")], "doc_id long, i int, token string, start int, stop int, tag string")
    faults = quality.document_faults(docs, toks, as_spans(spark, (0, 1, 2, "X")))
    assert tuples(faults, "rule") == [("entity_without_tags",), ("tags_without_entity",), ("token_text",)]
    assert quality.tokenisation_faults(docs, tokens.tokenise(docs)).count() == 0 and quality.tokenisation_faults(docs, toks).count() == 1
    assert tuples(quality.evaluation_faults(spark.createDataFrame([(1,), (1,), (2,)], "doc_id long"), spark.createDataFrame([(1,), (3,)], "doc_id long"))) == [(1, "predicted_twice"), (2, "unknown_document"), (3, "not_predicted")]


def test_text_functions(spark):
    one = spark.createDataFrame([("  Straße  X ", "a<b>c</b> &amp;lt;", "x <em>Ag</em>. <em>Hav</em> y <em>as</em>", "co-\nop  x\n\n\n\ny", "Transcript:Ha|LED0.5|LED1", "[1, 2, x]", "p-2020-i12#m")], "a string, b string, c string, d string, e string, f string, g string")
    r = one.select(t.normalised(F.col("a")), t.strip_tags(F.col("b")), t.highlighted(F.col("c")), t.clean_text(F.col("d")), t.ocr_note(F.col("e")), t.line_breaks(F.col("f")), t.issue_id(F.col("g")), t.year(F.lit("x"), F.lit("ab 1914-02"))).first()
    assert r[0] == "strasse x" and r[1] == "ac &lt;" and r[2] == "Ag. Hav as" and r[3] == "coop x\n\ny"
    assert tuple(r[4]) == ("Ha", 1.0) and list(r[5]) == [1, 2] and r[6] == "p-2020" and r[7] == 1914


def test_edits(spark):
    docs = spark.createDataFrame([(0, "a XX b XX c")], "doc_id long, text string")
    ents = spark.createDataFrame([(0, 0, 1, "p"), (0, 2, 4, "q"), (0, 10, 11, "r")], "doc_id long, start int, stop int, label string")
    text, moved = edits.replace_segment(docs, ents, "XX", "long", which=-1)
    assert text.first()["text"] == "a long b long c" and tuples(moved, "start", "label") == [(0, "p"), (14, "r")]
    assert edits.replace_segment(docs, ents, "XX", "y", which=1)[0].first()["text"] == "a XX b y c"
    with pytest.raises(Exception, match="more than once"):
        edits.replace_segment(docs, ents, "XX", "y")[0].collect()
    assert edits.compact_projection("a b x a b c", ["a", "b", "c"], [(0, 2)]) == [(6, 7), (8, 9), (10, 11)]
    embed = lambda texts: texts.map(lambda x: [float("hit" in x.split()), 1.0])
    words = ["w"] * 6 + ["hit"]
    found = edits.refined_passages(spark.createDataFrame([(1, words), (2, ["hit"]), (3, [])], "doc_id long, words array<string>"), [1.0, 0.0], embed, size=4, least=1, rounds=3, overlap=0.25)
    assert tuples(found, "doc_id", "round", "start", "stop") == [(1, 0, 3, 7), (1, 1, 5, 7), (1, 2, 6, 7), (2, 0, 0, 1)]
    vec = spark.createDataFrame([("m:AACAPwAAAEA=",), (None,)], "embedding string")
    assert [list(r["vector"]) for r in edits.decoded_vectors(vec).collect()] == [[1.0, 2.0], []]


def test_token_files_round_trip(spark, tmp_path):
    head = "\t".join(files.TOKEN_COLUMNS)
    line = lambda w, tag="O": "\t".join([w, "O", "O", tag, *["_"] * 9])
    body = [f"# global.columns = {' '.join(files.TOKEN_COLUMNS)}", "# language = fr", "# document_id = d1", "# segment_iiif_link = s1", head, line("La", "B-org"), "# segment_iiif_link = s1", line("x"), "# segment_iiif_link = s2", line("y"), "", "# language = de", "# document_id = d2", line("z")]
    (tmp_path / "x-dev.tsv").write_text("\n".join(body))
    got = files.read_token_files(spark, str(tmp_path)).orderBy("doc", "i").collect()
    assert [(r["doc"], r["i"], r["token"], r["segment"], r["comments"]["document_id"], r["split"]) for r in got] == [(0, 0, "La", 1, "d1", "validation"), (0, 1, "x", 1, "d1", "validation"), (0, 2, "y", 2, "d1", "validation"), (1, 0, "z", 0, "d2", "validation")]
    docs = spark.createDataFrame([(1, {"id": "d", "none": ""}, ["a\tb", "c"], ["O", "B-X"])], "doc_id long, meta map<string,string>, tokens array<string>, labels array<string>")
    assert files.token_file_text(docs).first()["block"] == "# id = d\nTOKEN\tLABEL\na b\tO\nc\tB-X\n"
    files.write_jsonl(spark.createDataFrame([("b", 1), ("A", None)], "id string, n int"), str(tmp_path / "out"), "id", one_file=True)
    assert next((tmp_path / "out").glob("part-*")).read_text() == '{"id":"A"}\n{"id":"b","n":1}\n'
    files.write_tsv(spark.createDataFrame([('a"b', "x\ty\nz", None), ("", " s", "q")], "a string, b string, c string"), str(tmp_path / "tsv"), ["b", "a", "c"])
    back = files.read_predictions(spark, str(tmp_path / "tsv"), "b string, a string, c string")
    assert sorted((r["b"], r["a"] or "", r["c"] or "") for r in back.collect()) == [(" s", "", "q"), ("x y z", 'a"b', "")]
    back = files.read_jsonl(spark, str(tmp_path / "out"), "id string, n int")
    assert tuples(back, "id") == [("A",), ("b",)]


def test_profiles(spark):
    rows = spark.createDataFrame([("k", "a", "A", 0), ("k", "a", "a", 1), ("k", "b", "b", 2), ("k", "c", "C", 3), ("k", "b", "b", 4)], "k string, form string, surface string, ord long")
    assert tuples(profile.top_surfaces(rows, ["k"], 2), "form", "n", "share", "display", "rank") == [("a", 2, 0.4, "A", 1), ("b", 2, 0.4, "b", 2)]
    p = profile.percentiles(spark.createDataFrame([(1, v) for v in range(10)], "g int, v int"), "v", ["g"], {"p50": 0.5, "p90": 0.9}).first()
    assert (p["p50"], p["p90"], p["most"], p["mean"]) == (4, 8, 9, 4.5)


def test_every_query_is_registered_with_its_twin():
    assert catalogue.FLAGSHIP in catalogue.queries() and set(catalogue.oracle_sql()) <= set(catalogue.queries())
    assert len(catalogue.oracle_sql()) > 55
