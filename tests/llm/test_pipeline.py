"""The registered queries against their SQL, and the pipeline stage by stage."""

import random
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.fixtures import DOCUMENTS, ODD_TEXTS, documents, words
from tests.llm.test_decontaminate import plain_leaks
from tests.llm.test_jaccard import by_all_pairs
from tests.llm.test_repeats import by_all_strings
from tools.compare import compare
from velotrace import session
from velotrace.llm import jaccard, registry, repeats


def test_every_operator_is_registered():
    found = [n.split("_")[0] for n in entry.queries() if n.startswith("op")]
    assert sorted(found) == sorted(f"op{n}" for n in range(1, 11)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, duck, name):
    assert compare(spark, duck, SMALL, name).startswith("same")


def write(frame, spark, folder, rows, items):
    documents(frame, rows, extra=True).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int("JUNK" not in (t or ""))) for i, t in rows if i is not None and t]
    frame("doc_id long, quality int, toxic int", *[(*x, 0) for x in labels]).write.parquet(f"{folder}/labels.parquet")
    frame("item_id long, text string", *items).write.parquet(f"{folder}/benchmark.parquet")


def test_each_stage_does_its_work(frame, spark, tmp_path):
    rng = random.Random(11)
    items = [(i, " ".join(words(rng, 40, 5000))) for i in range(5)]
    passage = " ".join(words(rng, 70, 5000))
    rows = [(i, " ".join(words(rng, rng.randrange(30, 150), 5000)), f"s{i % 3}") for i in range(80)]
    rows += [(100 + i, "JUNK!! " * rng.randrange(20, 60)) for i in range(25)]
    rows += [(200 + i, rows[i][1]) for i in range(5)] + [(300 + i, f"{rows[9 + i][1]} {items[i][1]}") for i in range(5)]
    rows += [(400 + i, f"{' '.join(words(rng, 40, 5000))} {passage} end{i}") for i in range(4)]
    rows += [(500 + i, t) for i, t in enumerate(ODD_TEXTS)] + [(None, "no id at all here"), (7, rows[7][1])]
    write(frame, spark, tmp_path, [r[:2] for r in rows], items)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r.doc_id, r.text) for r in docs.collect()]
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        seen[name] = after
        if k == 0:
            kept = {r.doc_id for r in after}
            assert not any(100 <= i < 125 for i in kept if i is not None)
            assert {r[0] for r in rows[:80]} <= kept
        if k == 1:
            want = {c for i, _, c in by_all_pairs(before, 5, 80) if i is not None}
            assert sorted(i for i in (r.doc_id for r in after) if i is not None) == sorted(want)
        if k == 2:
            want = {i: n - m for i, n, m, _, _ in by_all_strings(before)}
            assert len(after) == len(before)
            assert all(len((r.text or "").encode()) == want[r.doc_id] for r in after)
        if k == 3:
            want = sorted(str(i) for i, t in before if not plain_leaks(t, items))
            assert sorted(str(r.doc_id) for r in after) == want and len(after) < len(before)
        if k < 4:
            assert docs.columns == columns
    assert sorted(str(r.doc_id) for r in after) == sorted(str(i) for i, _ in before)
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, after))


def test_no_documents(frame, spark, tmp_path):
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_leave_only_the_tables_that_their_result_reads(frame, spark):
    rng = random.Random(13)
    passage = " ".join(words(rng, 70, 5000))
    rows = [(i, " ".join(words(rng, 60, 5000)) + passage * (i % 3 == 0)) for i in range(30)]
    rows += [(100 + i, rows[i][1]) for i in range(10)]
    rows_by_name = [*rows, (0, "another text under the same id")]
    folder = Path(session.shared_folder(spark).removeprefix("file:"))
    for make, given, left, wanted in (
        (jaccard.one_of_each, rows, {"found"}, 30),
        (jaccard.one_of_each, rows_by_name, {"found", "kept"}, 31),
        (repeats.cleaned, rows, {"changed-texts", "hot-join-keys"}, 40),
        (repeats.removal_counts, rows, {"changed", "hot-join-keys"}, 40),
    ):
        with session.scratch(spark):
            before = set(folder.iterdir())
            got = make(documents(frame, given, extra=True))
            new = {p.name[:-33] for p in set(folder.iterdir()) - before}
            assert new <= left and len(got.collect()) == wanted
        assert set(folder.iterdir()) == before


def test_written_tables_leave_no_shuffle_files(frame, spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        return {f for d in manager.localDirsString() for f in Path(d).rglob("shuffle_*")}

    rows = documents(frame, [(i, str(i % 7)) for i in range(100)])
    before = shuffled()
    named = spark.conf.get(session._CLEANUP, None)
    with session.scratch(spark):
        got = session.written(rows.groupBy("text").count().repartition(3, "count"), "counts")
        assert not shuffled() - before and sorted(r["count"] for r in got.collect()) == [14] * 5 + [15] * 2
    assert spark.conf.get(session._CLEANUP, None) == named
