from riskframe.llm import exact_dedup as X


def test_case_null_repeats_and_empty(make_docs, spark):
    docs = make_docs([(1, "ABÉ x"), (2, "abÉ x"), (3, "abé x"), (4, None), (5, ""), (5, ""), (7, "z")])
    got = sorted(map(tuple, X.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept").collect()))
    assert got == [(1, 2, 2, False), (2, 2, 2, True), (3, 3, 1, True), (4, 5, 3, False), (5, 5, 3, True), (5, 5, 3, True), (7, 7, 1, True)]
    assert X.exact_dedup(docs.where("false")).count() == 0


def test_new_data_meets_the_stored_index(make_docs, spark):
    index = X.DigestIndex(spark, "digest_index_test", buckets=4)
    index.create()
    first = X.digests(make_docs([(1, "a"), (2, "A"), (3, "b")]))
    index.append(first)
    later = X.digests(make_docs([(10, "a"), (11, "c"), (12, "C")]))
    plan = index.unseen(later.withColumnRenamed("doc_id", "keep_id"))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    index.append(later)
    got = {r.doc_id: (r.keep_id, r.kept) for r in index.decide(later).collect()}
    assert got == {10: (2, False), 11: (12, False), 12: (12, True)}
    assert spark.table("digest_index_test").count() == 3
    index.drop()


def test_buckets_follow_the_rows_expected_and_stay(make_docs, spark, monkeypatch):
    monkeypatch.setattr(X, "DIGESTS", 2)
    monkeypatch.setattr(X, "LEAST_BUCKETS", 3)
    index = X.DigestIndex(spark, "digest_index_sized")
    docs = make_docs([(i, f"text {i % 13} " * (1 + 20_000 * (i == 5))) for i in range(20)])
    try:
        got = X.exact_dedup(docs, index).collect()
        assert index.stored_buckets() == 10
        assert {r.doc_id: r.keep_id for r in got} == {i: i if i == 5 else (i + 13 if i < 7 and i != 5 else i) for i in range(20)}
        later = X.DigestIndex(spark, "digest_index_sized")      # as another session opens it
        again = X.exact_dedup(make_docs([(100, "TEXT 1 "), (101, "new")]), later).collect()
        assert {r.doc_id: r.keep_id for r in again} == {100: 14, 101: 101}
        assert later.stored_buckets() == 10
    finally:
        index.drop()


def test_clashing_columns(make_docs):
    docs = make_docs(["a", "a"]).selectExpr("*", "1 AS digest", "2 AS keep_id", "3 AS group_size", "4 AS kept")
    assert sorted(r.kept for r in X.exact_dedup(docs).collect()) == [False, True]
