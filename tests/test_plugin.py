import pytest

from kinweld.operators.mapping import map_records
from kinweld.sources import plugin


def test_parser_becomes_a_source(spark, tmp_path):
    (tmp_path / "a").write_text("Ada Lovelace;ada@x.io")
    (tmp_path / "b").write_text("broken")

    def parse(path):
        with open(path) as file:
            name, email = file.read().split(";")
        yield "u1", {"name": name, "email": email}, {"name": "regex"}

    plugin.register(spark, "semicolons", parse)
    records, bad = plugin.read(spark, "semicolons", "linkedin", [f"{tmp_path}/a", f"{tmp_path}/b"])
    got = map_records(records, {}).select("source", "full_name", "emails", "evidence").collect()
    assert [(r["source"], r["full_name"], r["emails"]) for r in got] == [("linkedin", "Ada Lovelace", ["ada@x.io"])]
    assert [e["method"] for e in got[0]["evidence"]][:2] == ["regex", "mapped_field"]
    assert [r["path"] for r in bad.collect()] == [f"{tmp_path}/b"]
    with pytest.raises(ValueError):
        plugin.read(spark, "semicolons", "nowhere", [])
