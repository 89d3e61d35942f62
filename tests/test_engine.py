import json
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from kinweld.functions.similarity import lcs_length
from kinweld.operators import matching as J
from kinweld.operators.components import components
from kinweld.operators.projection import ProjectionConfig, ProjectionError, json_rows, project
from kinweld.operators.validation import ValidationError, check, violations
from kinweld.plans.cli import main
from kinweld.plans.engine import Engine, PipelineError, write_json
from kinweld.sources.records import parse_csv

# The emails and phones of the two people are fixed: published ids rest on them.
CSV = 'location,name,skills,mail address,email,phone\n"Bletchley, UK",A. Lovelace,cpp | reactjs,,Ada@Example.com,(415) 555-2671\n"New York, USA",Grace B. Hopper,cobol;py,,GRACE@example.org,202.555.0187\n'
ATS = {"candidates": [{"id": 0, "candidate_id": "A1", "full_name": "Ada Byron Lovelace", "contact": {"email": "ada@example.com"}, "skills": ["React", "c plus plus"], "experience": [{"company": "Engines Inc", "start": "April 2020", "end": "present"}]}]}
RESUME = "Curriculum vitae, 2024\nAda Lovelace\ngithub.com/ada or ada@example.com\nEducation:\nTrinity | BSc in Logic | class of 2015\nTechnical Skills:\nPY; cpp\nWork Experience\nEngines Inc | Engineer | Jan 2020 to Present\n"


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark)


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    folder = tmp_path_factory.mktemp("in")
    (folder / "c.csv").write_text(CSV)
    (folder / "a.json").write_text(json.dumps(ATS))
    (folder / "bad.json").write_text("{not json")
    (folder / "mixed.json").write_text('{"results": [{"name": "x"}, 3]}')
    (folder / "r.TXT").write_text(RESUME)
    return folder


@pytest.fixture(scope="module")
def output(engine, inputs):
    rows = engine.run([f"{inputs}/c.csv"], [f"{inputs}/r.TXT"], [f"{inputs}/a.json", f"{inputs}/bad.json", f"{inputs}/mixed.json", f"{inputs}/none.json"])
    return [json.loads(r["json"]) for r in rows.collect()]


def test_three_sources_make_two_people(output):
    assert len(output) == 2
    assert [p["candidate_id"] for p in output] == sorted(p["candidate_id"] for p in output)
    grace, ada = sorted(output, key=lambda p: len(p["skills"]))
    assert grace["candidate_id"] == "cand_7cbe7f876dbb5bb59800e674d9866df9"
    assert grace["location"] == {"city": "New York", "region": None, "country": "US"} and grace["emails"] == ["grace@example.org"] and grace["phones"] == ["+12025550187"]
    assert ada["full_name"] == "Ada Byron Lovelace"
    assert ada["skills"] == ["Python", "C++", "React"]
    assert ada["links"]["github"] == "https://github.com/ada"
    assert ada["experience"][0] == {"company": "Engines Inc", "title": "Engineer", "start_date": "2020-01", "end_date": None, "description": None}
    assert ada["experience"][1]["start_date"] == "2020-04"
    assert ada["education"] == [{"institution": "Trinity", "degree": "BSc", "field_of_study": "Logic", "start_date": None, "end_date": "2015-01"}]
    assert {r["source"] for r in ada["provenance"]["skills"]} == {"resume", "ats", "csv"}
    email = {r["source"]: r for r in ada["provenance"]["emails"]}
    assert email["ats"]["extraction_method"] == "mapped_field" and email["ats"]["original_field"] == "contact.email"
    assert email["csv"]["source_id"] == "c.csv:2" and email["ats"]["source_id"] == "A1"
    assert ada["provenance"]["candidate_id"][0]["value"] == ada["candidate_id"]


def test_no_inputs(engine, tmp_path):
    with pytest.raises(PipelineError):
        engine.run(csv=[str(tmp_path / "none.csv")])


def test_csv_rules():
    assert parse_csv("") == ([], "no header")
    assert parse_csv("a,b\n") == ([], None)
    assert parse_csv("a,a, b \n1,2,3\n\n,\n\"x\ny\"\n") == ([{"a": "1", "a.1": "2", "b": "3"}, {}, {"a": "x\ny"}], None)
    assert parse_csv("a\n1,2\n")[1]


def profiles(spark, rows):
    """(id, emails, phones, link, name)."""
    made = spark.createDataFrame(rows, "id long, emails array<string>, phones array<string>, link string, full_name string")
    none = F.lit(None).cast("string")
    return made.withColumn("links", F.struct(F.col("link").alias("linkedin"), none.alias("github"), none.alias("portfolio")))


def test_matching_rules(spark):
    rows = [
        (0, ["a@x.io"], [], None, "Alex Kim"), (1, [], [], None, "Kim  ALEX"), (2, ["b@x.io"], [], None, "Alex Kim"),
        (3, ["c@x.io"], ["+1"], None, "Maria Lopez"), (4, ["d@x.io"], ["+1"], None, "Maria Lopes"), (5, ["e@x.io"], ["+2"], None, "Maria Lopez"),
        (6, [], [], "https://l.io/z", None), (7, [], [], "https://l.io/z", "Zed Zed"), (8, [], [], None, None),
    ]
    found = {r["id"]: r["component"] for r in J.match(profiles(spark, rows)).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8}
    with pytest.raises(ValueError):
        J.check_threshold(101)


@pytest.mark.parametrize("threshold", [70.0, 90.0, 100.0])
def test_name_join_loses_nothing(spark, threshold):
    import random

    rng = random.Random(5)
    base = ["ada lovelace", "grace hopper", "alan m turing", "bo li", "x"]
    names = set(base)
    for _ in range(60):
        s = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            s.insert(rng.randint(0, len(s)), rng.choice("abcxyz")) if rng.random() < 0.5 else s and s.pop(rng.randrange(len(s)))
        names.add("".join(s).strip() or "x")
    names = sorted(names)
    given = spark.createDataFrame([(n, k % 4) for k, n in enumerate(names)], "name string, mask int")
    got = {frozenset((r["name"], r["name2"])) for r in J.similar_names(given, threshold).collect()}
    want = {frozenset((a, b)) for (i, a), (j, b) in combinations(enumerate(names), 2) if (i % 4) & (j % 4) == 0 and 200 * lcs_length(a, b) / (len(a) + len(b)) >= threshold}
    assert got == want


def test_rarest_cut():
    import random
    from itertools import combinations_with_replacement

    rng = random.Random(4)
    for _ in range(200):
        size, pieces = rng.randint(1, 3), rng.randint(1, 3)
        costs = [rng.randint(0, 5) for _ in range(size * pieces + rng.randint(0, 4) - size + 1)]
        ways = [w for w in combinations_with_replacement(range(len(costs)), pieces) if all(b - a >= size for a, b in zip(w, w[1:]))]
        got = J.rarest_cut(costs, pieces, size)
        assert tuple(got) in ways and sum(costs[p] for p in got) == min(sum(costs[p] for p in w) for w in ways)


def skewed_people():
    """A third with one email and one name, another name near it, others."""
    rows = [(k, ["hot@x.io"] if k % 3 == 0 else [f"p{k // 2}@x.io"] if k % 5 else [], ["+1"] if k % 7 == 0 else [], None, ["Maria Lopez", "Maria Lopes", f"Person {k // 4} abc"][k % 3]) for k in range(300)]
    return rows + [(300, [], [], None, "Lopez Maria"), (301, [], [], None, "lopez  maria")]


@pytest.mark.parametrize("hot", [5, 1000])
def test_hot_values_and_names(spark, monkeypatch, hot):
    """The same components whichever values count as hot."""
    monkeypatch.setattr(J, "hot_bound", lambda n: hot)
    rows = skewed_people()
    parent = {r[0]: r[0] for r in rows}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(rows, 2):
        x, y = (" ".join(sorted(r[4].casefold().split())) for r in (a, b))
        blocked = any(p and q for p, q in zip(a[1:4], b[1:4], strict=True))
        if set(a[1]) & set(b[1]) or set(a[2]) & set(b[2]) or (not blocked and 200 * lcs_length(x, y) / (len(x) + len(y)) >= 90):
            low, high = sorted((root(a[0]), root(b[0])))
            parent[high] = low
    found = {r["id"]: r["component"] for r in J.match(profiles(spark, rows)).collect()}
    assert found == {k: root(k) for k in parent}


def test_hot_values_stay_where_they_are(spark, monkeypatch):
    """Rows of a hot value join by broadcast; only the others are shuffled."""
    monkeypatch.setattr(J, "hot_bound", lambda n: 50)
    edges = J.identifier_edges(profiles(spark, skewed_people()), "emails")
    text = edges._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text
    shared = [r for r in skewed_people() if r[1] == ["hot@x.io"]]
    assert edges.where("a = 0").count() == len(shared) - 1


def test_frequent_pieces_meet_in_blocks(spark, monkeypatch):
    """With one row a block, every pair of blocks of a piece meets once."""
    names = sorted({f"maria {a}{b} lopez" for a in "abcdefgh" for b in "abcdefgh"})
    given = spark.createDataFrame([(n, 0) for n in names], "name string, mask int")
    monkeypatch.setattr(J, "hot_bound", lambda n: 3)
    pairs = [tuple(sorted((r["name"], r["name2"]))) for r in J.similar_names(given, 90.0).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == set(combinations(names, 2)) - {p for p in combinations(names, 2) if 200 * lcs_length(*p) / (len(p[0]) + len(p[1])) < 90}


def test_components_of_a_chain(spark):
    nodes = spark.range(40)
    edges = spark.createDataFrame([(k, k + 1) for k in range(30)], "a long, b long")
    found = {r["id"]: r["component"] for r in components(nodes, edges).collect()}
    assert all(found[k] == (0 if k <= 30 else k) for k in range(40))


def simple(spark):
    return spark.createDataFrame([("cand_" + "a" * 32, "Ada", ["a@x.io"]), ("cand_" + "b" * 32, None, [])], "candidate_id string, full_name string, emails array<string>")


CONFIG = {"fields": ("candidate_id", "full_name", "emails"), "include_confidence": False, "include_provenance": False, "rename": {"candidate_id": "id"}}


def test_projection_policies(spark):
    assert project(simple(spark), ProjectionConfig(**CONFIG)).columns == ["id", "full_name", "emails"]
    rows = [json.loads(r["json"]) for r in json_rows(simple(spark), ProjectionConfig(**CONFIG)).collect()]
    assert rows[1] == {"id": "cand_" + "b" * 32, "full_name": None, "emails": None}
    rows = [json.loads(r["json"]) for r in json_rows(simple(spark), ProjectionConfig(**CONFIG, missing_value_policy="omit")).collect()]
    assert rows[1] == {"id": "cand_" + "b" * 32}
    with pytest.raises(ProjectionError, match="full_name"):
        project(simple(spark), ProjectionConfig(**CONFIG, missing_value_policy="error"))


@pytest.mark.parametrize("wrong", [{"fields": ["nope"]}, {"fields": ["emails", "emails"]}, {"rename": {"nope": "x"}}, {"rename": {"emails": " "}}, {"rename": {"emails": "phones"}}, {"missing_value_policy": "drop"}, {"extra": 1}, {"include_confidence": "yes"}])
def test_rejected_settings(wrong):
    with pytest.raises(ValueError):
        ProjectionConfig.from_dict(wrong)


def test_validation(spark):
    bad = spark.createDataFrame([("cand_x", ["a", "a"], ["12"])], "candidate_id string, emails array<string>, phones array<string>")
    found = violations(bad)
    assert {r["path"] for r in found.collect()} == {"candidate_id", "emails", "phones"}
    with pytest.raises(ValidationError, match="cand_x"):
        check(found)


def test_write_json_replaces_whole_files(spark, tmp_path):
    path = tmp_path / "deep" / "o.json"
    assert write_json(json_rows(simple(spark), ProjectionConfig(**CONFIG)), str(path)) == 2
    assert len(json.loads(path.read_text())) == 2 and path.read_text().endswith("]\n")
    assert write_json(json_rows(simple(spark).limit(0), ProjectionConfig(**CONFIG)), str(path)) == 0
    assert json.loads(path.read_text()) == []
    assert [p.name for p in path.parent.iterdir()] == ["o.json"]


def test_command_line(spark, inputs, tmp_path):
    assert main(["--output", str(tmp_path / "x.json")]) == 2
    assert main(["--ats", f"{inputs}/bad.json", "--output", str(tmp_path / "x.json")]) == 1
    assert not (tmp_path / "x.json").exists()


def test_stream_ingests_each_file_once(spark, engine, inputs, tmp_path):
    from kinweld.streaming.ingest import ingest, people

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(ATS))
    for _ in range(2):
        ingest(spark, str(folder), f"{tmp_path}/t", f"{tmp_path}/c", engine).awaitTermination()
    assert people(spark, f"{tmp_path}/t", engine).count() == 1


def test_name_ratio_compares_all_names(spark, tmp_path):
    from kinweld.plans import queries as Q

    keys = [*range(1, 60), *(572 * j for j in range(1, 30)), *(11_440_000 + 572 * j for j in range(30)), 11_440_004, 11_440_008]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k,) for k in range(1, 30)], "s_suppkey long").write.parquet(f"{tmp_path}/supplier.parquet")
    names = sorted({r["name"] for r in J.keys_of(Q.people(spark, str(tmp_path))).collect()})
    want = {(a, b, lcs_length(a, b)) for a, b in combinations(names, 2) if 200 * lcs_length(a, b) >= 90 * (len(a) + len(b))}
    got = list(map(tuple, Q.name_ratio(spark, str(tmp_path)).collect()))
    assert set(got) == want and len(got) == len(want)


def test_rejected_records_keep_a_reason(engine, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"name": "Bo Li", "linkedin": "http://[broken"}, {"name": "Cy Ng"}]))
    (tmp_path / "b.csv").write_text("name\nDi Ha\n")
    loaded = engine.load(csv=[f"{tmp_path}/b.csv", f"{tmp_path}/b.csv", f"{tmp_path}/gone.csv"], ats=[f"{tmp_path}/a.json"])
    assert sorted(r["n"] for r in loaded.counts().collect()) == [1, 1, 2]
    assert [r["error"] for r in loaded.bad_files.collect()] == ["no such file"]
    assert engine.profiles_of(loaded.records).count() == 3
    assert [tuple(r) for r in engine.rejected.collect()] == [("ats", "a.json:1", "invalid linkedin link")]


def test_many_files_are_one_scan(engine, tmp_path):
    for k in range(60):
        (tmp_path / f"r {k}.txt").write_text(f"Person {'x' * (k + 1)}\np{k}@example.com\n")
    loaded = engine.load(resumes=[f"{tmp_path}/r {k}.txt" for k in reversed(range(60))])
    found = loaded.records.orderBy("file_ord").collect()
    assert [r["source_id"] for r in found] == [f"r {k}.txt" for k in reversed(range(60))]


def test_scan_table_csv_and_write_folder(spark, tmp_path):
    from kinweld.plans.engine import write_folder
    from kinweld.sources.records import scan_table_csv

    (tmp_path / "big.csv").write_text('name, email\n"Li, Bo",b@x.io\n,\n')
    rows = scan_table_csv(spark, f"{tmp_path}/big.csv")
    assert [r["source_id"] for r in rows.collect()] == ["big.csv:2", "big.csv:3"]
    assert rows.selectExpr("CAST(fields['name'] AS string) n").collect()[0]["n"] == "Li, Bo"
    write_folder(json_rows(simple(spark), ProjectionConfig(**CONFIG)), f"{tmp_path}/out")
    assert spark.read.json(f"{tmp_path}/out").count() == 2


def test_threshold_zero_matches_all_compatible_names(spark):
    rows = [(0, ["a@x.io"], [], None, "Ann"), (1, [], ["+1"], None, "Bob"), (2, ["b@x.io"], [], None, "Cyd"), (3, ["c@x.io"], ["+2"], None, "Dot"), (4, [], [], None, "Eve")]
    found = {r["id"]: r["component"] for r in J.match(profiles(spark, rows), 0.0).collect()}
    assert found == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0}
    found = {r["id"]: r["component"] for r in J.match(profiles(spark, rows[2:4]), 0.0).collect()}
    assert found == {2: 2, 3: 3}


def test_sections_of_many_lines(spark):
    from kinweld.operators import extract as X

    text = "\n".join(["before", *(f"{h}\n{h} line" for h in ("Skills", "Education:") for _ in range(300))])
    row = spark.createDataFrame([(text,)], "t string").select(X.sections_of(X.lines_of(F.col("t"))).alias("s")).first()["s"]
    assert len(row) == 1200 and sum(r["line"] is None for r in row) == 600 and row[1] == ("skills", "Skills line")


def test_only_similar_names_are_written(spark, monkeypatch):
    """Names that share a frequent piece and no more leave no row behind."""
    names = [f"{k * 7919 % 100_000:05d} maria lopez" for k in range(60)]
    given = spark.createDataFrame([(n, 0) for n in names], "name string, mask int")
    written, write = [], J.materialized

    def noted(df, **measures):
        written.append((df.columns, df.count()))
        return write(df, **measures)

    monkeypatch.setattr(J, "materialized", noted)
    found = {tuple(sorted((r["name"], r["name2"]))) for r in J.similar_names(given, 90.0).collect()}
    similar = {tuple(sorted(p)) for p in combinations(names, 2) if 200 * lcs_length(*p) / (len(p[0]) + len(p[1])) >= 90}
    assert found == similar and 0 < len(similar) < 1770
    assert [n for columns, n in written if "name2" in columns] == [len(similar)]
