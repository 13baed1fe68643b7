from __future__ import annotations

import random

from threadloom.llm.line_dedup import repeated_spans, units_of, without_repeats


def brute(rows, unit, least):
    """Spans by walking the rows in order of id (none first), in memory."""
    seen, out = {}, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        run = []
        for start, end, words in [*units_of(t or "", unit), (None, None, None)]:
            if words in seen and start is not None:
                run.append((start, end, words))
                continue
            if run and sum(len(w.split()) for _, _, w in run) >= least:
                out.append((d, run[0][0], run[-1][1], len(run), sum(len(w.split()) for _, _, w in run), *seen[run[0][2]]))
            run = []
            if start is not None:
                seen[words] = (d, start)
    return sorted(out, key=str)


def made_rows():
    rnd = random.Random(7)
    word = lambda: "w%d" % rnd.randrange(500)
    sentence = lambda: " ".join(word() for _ in range(rnd.randrange(1, 12))).capitalize() + "."
    passages = [" ".join(sentence() for _ in range(9)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [sentence() for _ in range(rnd.randrange(12))]
        if i % 4 == 0:
            parts.insert(rnd.randrange(len(parts) + 1), rnd.choice(passages).upper() if i % 8 else rnd.choice(passages))
        rows.append((i, rnd.choice(["\n", " "]).join(parts)))
    return rows + [(500, rows[8][1]), (501, None), (502, ""), (None, rows[3][1]), (503, "x " * 3000 + ".\n" + rows[8][1])]


def test_equals_a_walk_in_memory(spark):
    rows = made_rows()
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id bigint, text string, start int").repartition(3)
    for unit, least in (("sentence", 20), ("line", 5), ("paragraph", 1)):
        got = repeated_spans(df, unit, least).drop("row").collect()
        assert sorted(map(tuple, got), key=str) == brute(rows, unit, least)


def test_removal_keeps_offsets(spark):
    rows = made_rows()
    texts = dict(rows)
    for r in without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string")).collect():
        at, rest = 0, ""
        for start, end in r.removed:
            rest += (texts[r.doc_id] or "")[at:start]
            at = end
        assert r.text == rest + (texts[r.doc_id] or "")[at:]


def test_repeated_rows_and_empty_table(spark):
    text = "One two three four five six seven. " * 2 + "Eight nine ten eleven twelve thirteen fourteen fifteen."
    df = spark.createDataFrame([(1, text), (1, text)], "doc_id bigint, text string").coalesce(1)
    assert [(r.start, r.end) for r in repeated_spans(df, least_words=20).collect()] == [(0, len(text))]
    assert repeated_spans(df.limit(0)).collect() == []


def test_short_lines_and_edited_passages_are_found(spark):
    line, passage = "Share this page with all of your friends today", [f"Sentence {i} of a passage that was copied." for i in range(5)]
    edited = [*passage[:2], "This one is new.", *passage[3:]]
    rows = [(i, f"Text number {i} is its own.\n{line}\nAnd it ends as {i}.") for i in range(30)] + [(40, " ".join(passage)), (41, " ".join(edited))]
    rows += [(42, "Yes."), (43, "yes.")]
    found = repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).drop("row").collect()
    assert sorted(map(tuple, found), key=str) == brute(rows, "sentence", 1)
    texts = dict(rows)
    assert [r.doc_id for r in sorted(found) if texts[r.doc_id][r.start : r.end] == line] == [*range(1, 30)]
    assert [r.n_words for r in sorted(found) if r.doc_id == 41] == [16, 16] and (43, 0, 4, 1, 1, 42, 0) in set(map(tuple, found))
