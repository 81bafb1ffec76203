import pyarrow.parquet as pq

from duolect.llm import line_dedup
from duolect.llm.line_dedup import cut, dedup_lines, keep_rest, units

PASSAGE = "This passage has rather more words than eight. It goes on. And it ends with quite a few more words here."


def test_units_cover_a_text_in_order():
    text = "One two. Three four five six seven eight nine ten!\nShort line\n\n  Last one"
    spans = list(units(text))
    assert [text[a:b].strip() for a, b, _ in spans] == ["One two.", "Three four five six seven eight nine ten!", "Short line", "Last one"]
    assert spans[0][2] is None and all(key for _, _, key in spans[1:])


def test_short_unit_counts_only_with_the_words_before_it():
    one = list(units("Alpha beta gamma delta epsilon zeta eta theta. Yes."))
    two = list(units("Other words come before this one in here now. Yes."))
    same = list(units("X. ALPHA beta gamma delta epsilon zeta eta  theta. Yes."))
    assert one[1][2] != two[1][2] and one[1][2] == same[2][2] and one[0][2] == same[1][2]


def test_passage_inside_other_lines_is_cut_but_for_the_first(make):
    rows = [(1, "Begin here. " + PASSAGE + " End here."), (2, "Quite another start. " + PASSAGE), (3, "A clean document. Of its own."), (4, PASSAGE)]
    found = {r.doc_id: r for r in dedup_lines(make(rows)).collect()}
    assert found[1].text == rows[0][1] and found[3].text == rows[2][1] and not found[1].removed
    assert found[2].text == "Quite another start. " and found[4].text == ""
    assert "".join(rows[1][1][a.start:a.stop] for a in found[2].removed) == PASSAGE


def test_whole_tables_match_a_walk_through_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen, want = set(), {}
    for row in sorted(docs.select("doc_id", "text").collect()):
        spans = [(a, b, key) for a, b, key in units(row.text) if key]
        gone = []
        for a, b, key in spans:
            if key in seen:
                gone.append((a, b))
            seen.add(key)
        want[row.doc_id] = cut(row.text, [a for a, _ in gone], [b for _, b in gone])
    assert {r.doc_id: r.text for r in dedup_lines(docs).collect()} == want


def test_odd_rows(odd):
    rows = dedup_lines(odd).collect()
    assert len(rows) == odd.count()
    assert [r.text for r in rows if r.doc_id == 0] == [None]
    long = {r.doc_id: r for r in rows if r.doc_id in (6, 7)}
    sentence = "Many words make one very long text. "  # seven words: the first in a text lacks words before it
    assert long[6].text.startswith(sentence * 2 + "xxx") and long[7].text == sentence
    kept = keep_rest(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id: r.n_chars for r in kept.collect() if r.doc_id == 4} == {4: 10}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in odd.collect()}


def test_documents_of_which_nothing_is_left_go(make):
    line = "These are more than eight words in one line."
    kept = keep_rest(make([(1, line), (2, line + "\n" + line), (3, " "), (4, None), (5, "x " + line)])).collect()
    assert {(r.doc_id, r.text, r.n_chars) for r in kept} == {(1, line, len(line)), (3, " ", 1), (4, None, None), (5, "x " + line, len(line) + 2)}


def test_empty_table(odd):
    assert dedup_lines(odd.limit(0)).count() == keep_rest(odd.limit(0)).count() == 0


def test_short_whole_lines_are_cut_under_any_text(make):
    short = "All rights reserved."
    rows = [(1, "One text stands over it.\n" + short + "\nMore of it follows."), (2, "Quite another one.\n  all  rights reserved. \nAnd an end."),
            (3, short), (4, "A longer line that says at its end: no more than this. " + short), (5, "Yes. No.\n" + short), (6, "Some words.\nYes. No.")]
    found = {r.doc_id: r.text for r in dedup_lines(make(rows)).collect()}
    assert found == {1: rows[0][1], 2: "Quite another one.\nAnd an end.", 3: "", 4: rows[3][1], 5: "Yes. No.\n", 6: "Some words.\n"}
    kept = {r.doc_id: (r.text, r.n_chars) for r in keep_rest(make(rows)).collect()}
    assert kept == {i: (t, len(t)) for i, t in {**found, 3: short}.items()}


def test_units_are_stored_in_few_row_groups(make, monkeypatch):
    stored, keep = {}, line_dedup.materialize
    monkeypatch.setattr(line_dedup, "materialize", lambda df, purpose, **kw: stored.setdefault(purpose, keep(df, purpose, **kw)))
    rows = [(i, "".join(f"This is line {n} of a text, longer than eight words.\n" for n in range(40))) for i in range(100)]
    assert dedup_lines(make(rows).coalesce(1)).where("text = ''").count() == 99
    for purpose, total in (("lines-units", 4000), ("lines-repeated", 40)):
        groups = [m.row_group(i).num_rows for f in stored[purpose].inputFiles()
                  for m in [pq.ParquetFile(f.removeprefix("file:").replace("///", "/")).metadata] for i in range(m.num_row_groups)]
        assert sum(groups) == total and len(groups) <= 8
