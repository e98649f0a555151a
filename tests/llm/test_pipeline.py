"""The pipeline's stages against plain versions, each on its own input."""

import pytest
from plain import near_groups, without_repeats, words

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from marketloom.llm import quality, queries
from marketloom.session import materialize


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for name, stage in pipeline.STAGES:
        docs.append(materialize(stage(spark, docs[-1], sf_dir), name.replace(" ", "-")))
    return docs


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_do_what_they_say(stages):
    start, good, single, cut, mixed, packed = stages
    assert all(d.columns == start.columns for d in (good, single, cut, mixed))
    kept = {r.doc_id for r in quality.judged(quality.measured(start)).where("kept").collect()}
    assert {i for i, _ in texts(good)} == kept
    component = near_groups(texts(good), 5, 8, 10)
    assert {i for i, _ in texts(single)} == {i for i, c in component.items() if i == c}
    left = {i: k.decode(errors="ignore") for i, (_, _, _, k) in without_repeats(texts(single)).items()}
    got = dict(texts(cut))
    assert got.keys() == {i for i, t in left.items() if t}
    assert all(abs(len(t) - len(left[i])) <= 2 for i, t in got.items())
    own = {i: len(words(t)) for i, t in texts(cut)}
    taken = {}
    for i, t in texts(mixed):
        taken[i] = taken.get(i, 0) + len(words(t))
    assert all(n <= 2 * own[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(own.values()), rel=0.01)
    pieces = packed.collect()
    assert sum(r.length for r in pieces if r.start == 0) > 0
    assert {r.doc_id for r in pieces} == set(taken)


def test_rows_are_judged_by_themselves(spark, sf_dir, as_documents):
    def good(k):
        return " ".join(f"word{k}x{i}" for i in range(80))

    rows = [(None, good(1), "en", "a"), (None, "too short", "en", "a"), (None, good(2), None, None),
            (7, good(3), "en", "a"), (7, "short too", "en", "a"), (8, good(4), "en", "a"), (9, None, "en", "a")]
    docs = as_documents(rows)
    got = pipeline.quality_rules(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert sorted(t for _, t in texts(got)) == sorted(good(k) for k in (1, 2, 3, 4))
    assert [r.row for r in got.collect()] == ["x"] * 4


def test_near_copies_go_row_by_row(spark, sf_dir, as_documents):
    a, b, c = (" ".join(f"{k}{i}" for i in range(80)) for k in "abc")
    docs = as_documents([(3, a, "en", "a"), (7, a, "en", "a"), (7, b, "en", "a"), (8, c, "en", "a"), (8, c, "en", "a"),
                         (None, b, "en", "a"), (None, None, "en", "a")])
    got = pipeline.near_duplicates(spark, docs, sf_dir)
    assert got.columns == docs.columns
    assert sorted(texts(got), key=repr) == sorted([(3, a), (7, b), (8, c), (None, None)], key=repr)
    cut = pipeline.repeated_passages(spark, docs.where("doc_id = 7"), sf_dir)
    assert sorted(texts(cut)) == [(7, a), (7, b)]


def test_an_empty_table_passes_all_stages(spark, sf_dir, as_documents):
    docs = as_documents([(1, "x", "en", "a")]).limit(0)
    for name, stage in pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    assert docs.count() == 0


def test_queries_are_registered_in_the_entry():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {n.split("_")[0] + "_" for n in names} and "pipeline" in names
    assert set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
