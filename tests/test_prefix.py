import random

from pyspark.sql import functions as F

from tidewater.operators.prefix import running_sums, with_chunks


def test_running_sums_match_plain_loop(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b"]), rnd.randint(0, 20), i, float(rnd.randint(1, 5)))
            for i in range(400)]
    df = with_chunks(spark.createDataFrame(rows, "k string, day int, id int, q double"), "k", ["day", "id"], ranges=10)
    split = df.filter("k = 'hot'").select("chunk").distinct().count()
    assert split >= 8 and df.filter("k = 'a'").select("chunk").distinct().count() == 1
    out = running_sums(df, "k", ["day", "id"], {"incl": F.col("q")}, inclusive=True,
                       key_max={"last_day": F.col("day")})
    excl = running_sums(df, "k", ["day", "id"], {"excl": F.col("q")}, inclusive=False)
    got = {r.id: (r.incl, r.last_day) for r in out.collect()}
    got_ex = {r.id: r.excl for r in excl.collect()}
    acc, last = {}, {}
    for k, day, i, q in rows:
        last[k] = max(last.get(k, -1), day)
    for k, day, i, q in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        prev = acc.get(k, 0.0)
        assert got_ex[i] == prev
        acc[k] = prev + q
        assert got[i] == (acc[k], last[k])
