"""Near-duplicate removal with null and repeated ids."""

from corpusmill.llm import jaccard_join

WORDS = [f"w{i}" for i in range(100)]
NEAR = [" ".join([*WORDS[:-1], end]) for end in ("x", "y", "z")]
OTHER = [" ".join(f"{name}{i}" for i in range(30)) for name in "abcd"]


def kept(spark, rows):
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, k int")
    got = jaccard_join.drop_near_copies(docs)
    assert got.columns == docs.columns
    out = got.collect()
    assert all(rows[r["k"]] == (r["doc_id"], r["text"]) for r in out)
    return sorted(r["k"] for r in out)


def test_a_null_loser_takes_no_other_row_along(spark):
    assert kept(spark, [(3, NEAR[0]), (None, NEAR[1]), (None, OTHER[0]), (None, ""), (None, None), (4, OTHER[1])]) == [0, 2, 3, 4, 5]


def test_a_repeated_id_loses_only_the_near_copy(spark):
    assert kept(spark, [(3, NEAR[0]), (5, OTHER[0]), (5, NEAR[1]), (5, " ")]) == [0, 1, 3]


def test_of_near_copies_with_one_id_or_none_one_stays(spark):
    got = kept(spark, [(7, NEAR[0]), (7, NEAR[1]), (None, OTHER[0]), (None, OTHER[0] + " end"), (8, OTHER[1]), (8, OTHER[1])])
    assert len(got) == 3 and [len({0, 1} & set(got)), len({2, 3} & set(got)), len({4, 5} & set(got))] == [1, 1, 1]
    assert kept(spark, [(9, NEAR[0]), (2, NEAR[1]), (6, NEAR[2]), (None, OTHER[0])]) == [1, 3]


def test_one_id_in_two_components_wins_and_loses(spark):
    assert kept(spark, [(5, NEAR[0]), (6, NEAR[1]), (5, OTHER[0]), (2, OTHER[0] + " end")]) == [0, 3]
