"""Golden rows for rules, spans and stores."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from threadloom.functions import predicates as P
from threadloom.functions import text as T
from threadloom.operators import evaluation, extraction, messages, resolver, reuse, store

CASE = "text string, role string, prev_role string, opening boolean, same_conversation boolean, matched int, total int, prior boolean"
LONG = "word " * 80


def verdicts(spark, *cases):
    rows = [{"role": "user", "prev_role": "assistant", "opening": False, "same_conversation": None, "matched": None, "total": 40, "prior": None} | c for c in cases]
    df = spark.createDataFrame([[r[k.split()[0]] for k in CASE.split(", ")] for r in rows], CASE).withColumn("n", F.monotonically_increasing_id())
    return [{v: (r[v].cls, r[v].adoption) for v in resolver.VERSIONS} for r in resolver.resolve(df.coalesce(1)).collect()]


def test_resolver_rules(spark):
    origin = {"matched": 20, "same_conversation": False, "prior": True}
    got = verdicts(
        spark, {"text": "anything", "role": "assistant"}, {"text": "no, not what i meant"}, {"text": "Pros: 1. a\nCons: 1. b"}, {"text": LONG, **origin}, {"text": "yes, but change the title to Plan"},
        {"text": "Please unsubscribe me " + LONG + LONG}, {"text": "maybe " + LONG + LONG}, {"text": "can you rewrite this email below:\n\n" + LONG, **origin}, {"text": "i did not say that " + LONG, **origin}, {"text": "my chrome extension\n\nsummarize " + LONG, **origin},
    )
    assert got[0]["v1"] == got[0]["v6"] == ("A0", "AD0")
    assert got[1]["v1"] == ("X0", "AD0") and got[1]["v2"] == ("X0", "AD0") and got[1]["v3"][0] == "D0"
    assert got[2]["v1"][0] == got[2]["v2"][0] == got[2]["v3"][0] == "P0"
    assert got[3]["v1"] == ("P0", "AD1") and got[3]["v3"][0] == "P0" and got[3]["v4"][0] == "P0"
    assert got[4]["v1"] == ("D0", "AD4") and got[4]["v3"] == ("D0", "AD4") and got[4]["gate5"][0] == "D0"
    assert got[5]["v1"][0] == "MIXED" and got[5]["v2"][0] == "MIXED" and got[5]["v3"][0] == "UNRESOLVED"
    assert got[6]["v1"][0] == "UNRESOLVED" and got[6]["v2"][0] == "UNRESOLVED"
    assert got[7]["v4"][0] == "MIXED" and got[7]["v6"] == ("P0", "AD4")
    assert got[8]["v5"][0] == "UNRESOLVED" and got[8]["v4"][0] == "P0"
    assert got[9]["v4"][0] == "MIXED" and got[9]["v6"][0] == "UNRESOLVED"


@pytest.mark.parametrize("name,yes,no", [("approval", " Love it", "do not love it"), ("rejection", "wrong", "i was wrong"), ("weak", "hmm.", "hmm. well"), ("structured", "a\n## b", "a ## b"), ("import_markers", "x\nSubject: y", "the subject: y"), ("gate_continue", "what if we", "so what if")])
def test_predicates(spark, name, yes, no):
    assert [r[0] for r in spark.createDataFrame([(yes,), (no,)], "t string").select(P.holds(name, F.col("t"))).collect()] == [True, False]


def test_predicates_read_borders_lines_and_space_as_re2_does(spark):
    import duckdb

    texts = ["Doías de y", "yes\u00e1", "do", "do_it", "Subject\u2028subject: x", "x\rfrom: me", "no\u000b", "ok\r", "a\nsubject: y", "Do.", "made\u00edcan you", "1. a\u0085b\nc\nd"]
    names = [*P.PATTERNS]
    got = spark.createDataFrame([*enumerate(texts)], "i int, text string").select("i", *(P.holds(n, F.col("text")).alias(n) for n in names)).orderBy("i").collect()
    for i, text in enumerate(texts):
        want = {n: duckdb.execute("SELECT regexp_matches(?, ?)", [text, P.PATTERNS[n]]).fetchone()[0] for n in names}
        assert {n: got[i][n] for n in names} == want, text
    assert got[0]["directive"]


def test_text_functions(spark):
    one = lambda c, *v: spark.range(1).select(c(*(F.lit(x) for x in v))).first()[0]
    assert one(T.summary, "  One  two. Three") == "One two." and one(T.summary, "") == "" and len(one(T.summary, "x" * 500)) == 160
    assert one(T.safe_title, "# - ") == "Untitled Extracted Knowledge"
    assert one(lambda w: T.shingles(F.split(w, " "), 12), "a b") == []
    assert one(T.iso_from_seconds, 0.5) == "1970-01-01T00:00:00.500000+00:00" and one(T.iso_from_seconds, 1e18).startswith("UNPARSEABLE_RAW:")
    assert one(lambda a, b: T.gap_days(a, b), "2024-01-03T12:00:00Z", "2024-01-01T00:00:00Z") == 2.5
    assert one(T.overlap_class, 0.35) == "near" and one(T.transformation_distance, 0.1) == "TD5"


def test_drifting_span():
    assert reuse.drifting_span([0, 1, 2, 3], [10, 11, 12, 13]) == (4, 1, 3)
    assert reuse.drifting_span([0, 1, 9, 10], [0, 1, 12, 13]) == (2, 1, 10)  # drift of 3, but a gap of 8
    assert reuse.drifting_span([0, 1, 2], [0, 1, 50]) == (2, 2, 2)
    assert reuse.drifting_span([], []) == (0, 0, 0)


def test_chronology_is_three_valued(spark):
    rows = spark.createDataFrame([(1, 2), (2, 1), (None, 1), (1, None)], "o int, r int").select(reuse.chronology_valid(F.col("o"), F.col("r")))
    assert [r[0] for r in rows.collect()] == [True, False, None, None]


def test_coarse_pairs_need_five_shingles_of_another_record(spark):
    w = [f"w{i}" for i in range(400)]
    texts = [(1, " ".join(w[:40])), (2, " ".join(w[24:80])), (3, " ".join(w[25:39] + w[100:140])), (4, " ".join(w[200:230] * 3))]
    passages = reuse.hashed_passages(spark.createDataFrame(texts, "canonical_id bigint, text string"))
    assert {(r.reuse_id, r.origin_id, r.shared) for r in reuse.coarse_pairs(passages).collect()} == {(1, 2, 5), (2, 1, 5)}


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, x) for x in range(101, 120)]
    got = {r.v: r.root for r in reuse.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, **{i: 100 for i in range(100, 120)}}


def test_main_path_with_a_cycle_and_branches(spark):
    nodes = spark.createDataFrame([("a", "r", None), ("a", "x", "r"), ("a", "y", "x"), ("a", "z", "x"), ("b", "p", "q"), ("b", "q", "p"), ("c", "n", None)], "conversation_id string, node_id string, parent string")
    heads = spark.createDataFrame([("a", "z"), ("b", "p"), ("c", "gone")], "conversation_id string, current_node string")
    got = {(r.conversation_id, r.node_id): (r.sequence_index, r.branch) for r in messages.main_path(nodes, heads).collect()}
    assert got["a", "r"] == (0, "main") and got["a", "z"] == (2, "main") and got["a", "y"] == (None, "alternate") and got["c", "n"][1] == "alternate" and got["b", "p"][1] == "main"


SCHEMA = "source_file string, conversation_id string, ts string, canonical_id string, message_id string, role string, text string"


def test_extraction_markers(spark):
    texts = ["Entity: Loom (product)\nrelationship: Loom | depends_on | Yarn", "Entity: Yarn | technology\ntimeline: 2024-05-01 | Approved | first cut", "Person: Ann\nrelationship: Loom builds on Yarn\ntimeline: 2024-05-02 | dreamt | x", "   ", "entity: loom (product)", "relationship: Loom | depends_on | Nothing"]
    df = spark.createDataFrame([("f", "c", f"2024-01-0{i + 1}", f"s{i}", f"m{i}", "user", t) for i, t in enumerate(texts)], SCHEMA)
    thoughts, entities = extraction.thoughts(df), extraction.entities(df)
    assert thoughts.count() == 5
    assert {(r.norm, r.type, r.mention_count) for r in entities.collect()} == {("loom", "product", 2), ("yarn", "technology", 1), ("ann", "person", 1)}
    assert sorted(r.type for r in extraction.relationships(df, thoughts, entities).collect()) == ["builds_on", "depends_on"]
    assert [(r.date, r.event) for r in extraction.timelines(df, thoughts).where("event <> 'originated'").collect()] == [("2024-05-01", "approved")]


STORE = "knowledge_id string, revision int, canonical_status string, title string, summary string, content string, evidence_ids array<string>, approval_status string, projection_policy string"


def test_store_lifecycle(spark):
    s = spark.createDataFrame([("K1", 1, "SUPERSEDED", "old loom", "s", "c", ["e"], "ACCEPTED", "PUBLISH"), ("K1", 2, "CURRENT", "loom", "a summary", "one two three four five", ["e1"], "ACCEPTED", "PUBLISH"), ("K2", 1, "CURRENT", "yarn", "b", "loom thread", ["e2"], "PENDING", "PUBLISH")], STORE)
    assert store.get(s, "K1").first().revision == 2 and store.get(s, "K1", 1).first().title == "old loom"
    with pytest.raises(store.NotFound):
        store.get(s, "K9")
    assert [(r.knowledge_id, r.score) for r in store.search(s, "loom thread").collect()] == [("K2", 4), ("K1", 1)]
    with pytest.raises(ValueError):
        store.search(s, " ")
    assert store.violations(s).isEmpty() and {r.rule for r in store.violations(s.unionByName(s)).collect()} == {"duplicate_revision", "several_current"}
    c = spark.createDataFrame(
        [("c1", 1, "UPDATE", "K1", 2, "one two three", ["e1"]), ("c2", 1, "UPDATE", "K1", 2, "five one two three four", ["x"]), ("c3", 1, "UPDATE", "K1", 2, "six one two three four", ["x"]), ("c4", 1, "UPDATE", "K1", 1, "z", []), ("c5", 1, "RETIRE", "K1", None, "z", []), ("c6", 1, "CREATE", None, None, "z", []), ("c7", 1, "UPDATE", "K9", None, "z", []), ("c8", 1, "CREATE", "K1", None, "z", [])],
        "candidate_id string, candidate_revision int, proposed_operation string, proposed_knowledge_id string, base_canonical_revision int, content string, evidence_ids array<string>",
    )
    got = {r.candidate_id: r.classification for r in store.review(c, s).collect()}
    assert got == {"c1": "DUPLICATE", "c2": "REAFFIRMATION", "c3": "UPDATE", "c4": "CONFLICT", "c5": "RETIREMENT", "c6": "NEW_KNOWLEDGE", "c7": "INSUFFICIENT_EVIDENCE", "c8": "INSUFFICIENT_EVIDENCE"}  # c3: 4 of 5 words, not more than 0.8
    verified = spark.createDataFrame([("e1",)], "evidence_id string")
    assert {r.candidate_id: r.n_supporting for r in store.review(c, s, verified).collect()}["c2"] == 0
    notes = spark.createDataFrame([("K1", 1, "h", True, False)], "knowledge_id string, note_revision int, note_hash string, managed boolean, tampered boolean")
    assert [(r.knowledge_id, r.action) for r in store.projection(s, notes).collect()] == [("K1", "published")]


def test_evaluation_with_empty_denominators(spark):
    rows = spark.createDataFrame([("a", "b"), ("a", "a"), ("c", "a")], "t string, p string")
    got = {r["class"]: (r.precision, r.recall) for r in evaluation.precision_recall(rows, "t", "p").collect()}
    assert got["b"] == (0.0, None) and got["c"] == (None, 0.0) and got["a"] == (0.5, 0.5)
    assert {r["class"]: r.recall for r in evaluation.precision_recall(rows, "t", "p", zero=0.0).collect()}["b"] == 0.0


def test_cases_hash_words_once_and_follow_scan_order(spark, monkeypatch):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [("f2", "c1", "a1", 0, "assistant", "2024-01-01", text), ("f1", "c2", "a2", 0, "assistant", None, text), ("f3", "c3", "u1", 0, "user", "2024-01-03", text + " " + text), ("f3", "c3", "a3", 1, "assistant", "2024-01-04", text)]
    labels, keep = [], resolver.stored
    monkeypatch.setattr(resolver, "stored", lambda df, label: labels.append(label) or keep(df, label))
    made = resolver.build_cases(spark.createDataFrame(rows, "source_file string, conversation_id string, canonical_id string, turn int, role string, ts string, text string"))
    got = {r.canonical_id: (r.matched, r.total, r.origin_id, r.n_origins, r.prior) for r in made.collect()}
    # The first file's message has all shingles first, and repeats count.
    assert got["u1"] == (58, 69, "a2", 1, False) and got["a3"] == (None, 29, None, 0, None) and len(got) == 4
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert labels == ["case-shingles", "case-places"] and "hashpartitioning(sh" in plan and "xxhash64" not in plan
