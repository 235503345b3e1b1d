from pyspark.sql import functions as F

from ledgerlift.llm.line_spread import boilerplate_lines, remove_boilerplate

LINE = "All rights reserved by all of us."


def rows_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    return {r.doc_id: r for r in remove_boilerplate(docs).collect()}


def test_removes_spread_lines_and_keeps_others(spark):
    own = [f"Here is what only document {i} has to say about it, at some length." for i in range(9)]
    rows = [(i, f"{own[i]}\n  {LINE} \nToo short\n{own[i]}", f"s{i}") for i in range(6)]
    rows += [(6, f"{own[6]}\nTwice on one site only, this line.", "s1")]
    rows += [(7, f"{own[7]}\nTwice on one site only, this line.", "s1")]
    found = rows_of(spark, rows)
    for i in range(6):
        assert found[i].text == f"{own[i]}\nToo short\n{own[i]}"
        assert (found[i].n_lines, found[i].n_boilerplate, found[i].n_removed) == (4, 1, 1)
    for i in (6, 7):
        assert found[i].text == rows[i][1] and found[i].n_removed == 0


def test_what_is_boilerplate_almost_wholly_stays_whole(spark):
    copy = "\n".join(f"Line {i} of a text that has been copied." for i in range(12))
    rows = [(i, copy, f"s{i}") for i in range(8)] + [(9, copy + "\nOne edited line here.", "s9")]
    found = rows_of(spark, rows)
    assert all(found[i].text == t for i, t, _ in rows)
    assert found[0].n_boilerplate == 12 and found[9].n_boilerplate == 12
    assert found[0].n_removed == found[9].n_removed == 0


def test_what_near_copies_are_not_loses_its_boilerplate(spark):
    """Between a half and eight ninths of a text, no later stage would act."""
    shared = "\n".join(f"Line {i} of what many sites have." for i in range(8))
    own = {i: f"What text {i} says itself, and nobody else: " + f"w{i} " * 14 for i in range(8)}
    found = rows_of(spark, [(i, f"{shared}\n{x}", f"s{i}") for i, x in own.items()])
    assert len(shared) > 2 * len(own[0])
    assert {i: r.text for i, r in found.items()} == own
    assert {r.n_removed for r in found.values()} == {8}


def test_lines_without_spaces_count_by_their_characters(spark):
    line = "版权所有未经许可不得转载本站内容仅供参考如有侵权请联系删除谢谢"
    rows = [(i, f"{line}\n短线\nThis is what document {i} says, in a long line.", f"s{i}") for i in range(9)]
    for r in rows_of(spark, rows).values():
        assert r.text == f"短线\nThis is what document {r.doc_id} says, in a long line."


def test_hot_lines_and_null_ids(spark):
    """A line in nearly all of very many rows, whose ids are null."""
    rows = [(None, f"{LINE}\nSome words of row {i}, and more of them.", f"s{i % 7}") for i in range(3000)]
    rows += [(1, f"{LINE}\nA row of its own, with words.", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(7)
    got = sorted(r.text for r in remove_boilerplate(docs).collect())
    assert got == sorted(t.split("\n")[1] for _, t, _ in rows)


def test_columns_of_any_name_pass(odd_documents):
    names = ["_lines", "_found", "_row", "_id", "_hash", "_own", "_kept", "_rest", "line", "text_hash"]
    docs = odd_documents.withColumns({c: F.lit(f"their {c}") for c in names})
    out = remove_boilerplate(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_boilerplate", "n_removed"]
    assert all(r[c] == f"their {c}" for r in out.collect() for c in names)


def test_threshold_is_exact_near_and_far(spark):
    counts = [1, 2, 5, 18, 19, 20, 21, 22, 40, 300]
    rows = [(i, f"site {k % n}") for i, n in enumerate(counts) for k in range(3 * n)]
    lines = spark.createDataFrame(rows, "line bigint, site string")
    found = {r.line for r in boilerplate_lines(lines, min_sites=20).collect()}
    assert found == {i for i, n in enumerate(counts) if n >= 20}


def test_odd_rows(spark, odd_documents):
    rows = odd_documents.collect()
    cleaned = remove_boilerplate(odd_documents.withColumn("n_lines", F.lit("theirs"))).collect()
    assert sorted((r.doc_id or -1, r.text or "") for r in cleaned) == sorted(
        (r.doc_id or -1, r.text or "") for r in rows
    )
    assert all(r.n_lines == (0 if r.text is None else r.text.count("\n") + 1) for r in cleaned)
    text = "A line of some words.\nAnd one that nobody else has, which is longer."
    same = [(i if i < 3 else None, text if i % 2 else text + " More.", f"s{i}") for i in range(6)]
    same += [(0, None, None), (0, "Another text with this id.", "s1")]
    docs = spark.createDataFrame(same, "doc_id bigint, text string, source string")
    got = [r.text for r in remove_boilerplate(docs, min_sites=6).collect()]
    assert len(got) == 8 and got.count(None) == 1
    assert sum(t == "And one that nobody else has, which is longer." for t in got) == 3


def test_no_rows(no_documents):
    assert remove_boilerplate(no_documents).count() == 0
