from threading import Event, Thread

from conftest import tuples

from tallyhouse.sources import tables


def test_readers_never_fail_while_a_view_is_replaced(spark, tmp_path):
    tables.create_database(spark, "views_test", str(tmp_path))
    name = "views_test.days"
    versions = [
        (spark.createDataFrame([(i, "07", i * 2)], "a bigint, part string, c bigint"), ["part"] if i % 2 else None)
        for i in range(6)
    ]
    # the other form of the schema, with other partitions
    versions += [(spark.createDataFrame([(9, "x")], "a bigint, b string"), ["b"])]
    tables.replace_view(*versions[0][:1], name, versions[0][1], str(tmp_path))
    done, failures, seen = Event(), [], set()

    def read():
        while not done.is_set():
            try:
                rows = spark.table(name).select("a").collect()
                seen.add(tuple(r[0] for r in rows))
            except Exception as problem:
                failures.append(problem)

    reader = Thread(target=read)
    reader.start()
    for df, parts in versions[1:]:
        tables.replace_view(df, name, parts, str(tmp_path))
    done.set()
    reader.join()
    assert not failures, str(failures[0])[:1500]
    assert seen and seen <= {(i,) for i in range(6)} | {(9,)}
    assert tuples(spark.table(name)) == [(9, "x")]
    assert tables.remove_old_versions(spark, name, str(tmp_path)) == 6
    assert tuples(spark.table(name)) == [(9, "x")]


def test_a_view_over_itself_keeps_types(spark, tmp_path):
    tables.create_database(spark, "views_test2", str(tmp_path))
    name = "views_test2.parts"
    tables.replace_view(spark.createDataFrame([(1, "07"), (2, None)], "a int, part string"), name, ["part"], str(tmp_path))
    assert tuples(spark.table(name)) == [(1, "07"), (2, None)]
    got = tables.replace_view(spark.table(name).selectExpr("a + 1L AS a", "part"), name, None, str(tmp_path))
    assert dict(got.dtypes) == {"a": "bigint", "part": "string"} and got.count() == 2
