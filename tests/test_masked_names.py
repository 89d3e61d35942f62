"""Names that can't match, as both have a kind of identifier, don't meet."""

from pyspark.sql import functions as F

from kinweld.operators import matching as J


def test_names_with_a_kind_in_common_do_not_meet(spark, monkeypatch):
    """200 names much alike, all of people with a phone, among two others."""
    masks = [2, 3, 6, 7]
    names = [(f"{k:03d} ada lovelace", masks[k % 4]) for k in range(200)] + [("ada lovelace", 1), ("7 ada lovelace", 0)]
    given = spark.createDataFrame(names, "name string, mask int").localCheckpoint()
    met, dealt = [], J._in_blocks

    def noted(*args):
        rows = dealt(*args)
        met.append(rows.count())
        return rows

    monkeypatch.setattr(J, "_in_blocks", noted)
    found = {(r["name"], r["mask"], r["name2"], r["mask2"]) for r in J.similar_names(given, 90.0).collect()}
    assert ("ada lovelace", 1, "7 ada lovelace", 0) in found
    assert all(m & n == 0 for _, m, _, n in found)
    # Each with the two others, by five pieces at most, and the two themselves.
    assert met[0] <= 2 * 202 * 5


def test_pieces_that_stand_in_no_name_to_meet_are_left_out(spark):
    names = spark.createDataFrame([("12345 ada lovelace", 2), ("67890 ada lovelace", 2), ("bo lindgren", 1)], "name string, mask int")
    shorter, longer = J.masks_to_meet(names)
    counts = J._probes(longer, 90.0).groupBy(*J.MET).agg(F.count(F.lit(1)).alias("n"))
    assert {r["name"] for r in J._pieces(shorter, 90.0, counts, 1000).collect()} <= {"bo lindgren"}
