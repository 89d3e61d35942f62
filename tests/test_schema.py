"""Schemas compiled to columns against a judge of JSON values, row by row."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from kinweld.operators import schema as S
from kinweld.operators.projection import ProjectionConfig
from kinweld.operators.validation import ValidationError, canonical_report, profile_schema, projected_schema, validate_canonical, validate_projected, violations
from kinweld.plans.engine import Engine

COLUMNS = "s string, n double, i bigint, b boolean, l array<string>, o struct<x:string,y:double>, m map<string,bigint>, d array<struct<k:string,v:array<bigint>>>"
SCHEMA = {
    "type": "array",
    "$defs": {"word": {"type": "string", "pattern": "^[a-z$]+$", "maxLength": 3}, "row/part": {"type": "object", "properties": {"k": {"$ref": "#/$defs/word"}, "v": {"type": "array", "items": {"minimum": 2, "exclusiveMaximum": 5}, "minItems": 1}}}},
    "items": {
        "properties": {
            "s": {"anyOf": [{"type": "null"}, {"$ref": "#/$defs/word"}]},
            "n": {"type": ["number", "null"], "minimum": 0, "maximum": 2},
            "i": {"enum": [1, 2, None]},
            "b": {"const": True},
            "l": {"type": "array", "uniqueItems": True, "items": {"oneOf": [{"pattern": "a"}, {"pattern": "b"}]}, "maxItems": 3},
            "o": {"type": ["object", "null"], "properties": {"x": {"not": {"enum": ["z", None]}}, "y": {"type": ["integer", "null"]}}, "additionalProperties": False},
            "m": {"allOf": [{"required": ["a"]}, {"properties": {"a": {"minimum": 1}}, "additionalProperties": {"maximum": 3}}], "maxProperties": 2},
            "d": {"type": "array", "items": {"$ref": "#/$defs/row~1part"}},
        },
        "additionalProperties": False,
    },
}


def judge(schema, v, path=()):
    """Paths of what is wrong with a JSON value."""
    if schema is True or schema == {}:
        return []
    kinds = {"null": v is None, "string": isinstance(v, str), "boolean": isinstance(v, bool), "number": isinstance(v, (int, float)) and not isinstance(v, bool), "array": isinstance(v, list), "object": isinstance(v, dict)}
    kinds["integer"] = kinds["number"] and v == int(v)
    out, wrong = [], lambda bad: out.append(path) if bad else None
    for key, arg in schema.items():
        if key == "$ref":
            at = SCHEMA
            for part in arg[2:].split("/"):
                at = at[part.replace("~1", "/")]
            out += judge(at, v, path)
        elif key == "type":
            wrong(not any(kinds[t] for t in ([arg] if isinstance(arg, str) else arg)))
        elif key == "enum":
            wrong(v not in arg)
        elif key == "const":
            wrong(v != arg)
        elif key == "not":
            wrong(not judge(arg, v))
        elif key == "allOf":
            for one in arg:
                out += judge(one, v, path)
        elif key == "oneOf":
            wrong(sum(not judge(one, v) for one in arg) != 1)
        elif key == "anyOf":
            wrong(all(judge(one, v) for one in arg)) if v is None or len(arg) != 2 else out.extend(judge(arg[1], v, path))
        elif key in ("minimum", "maximum", "exclusiveMaximum") and kinds["number"]:
            wrong({"minimum": v < arg, "maximum": v > arg, "exclusiveMaximum": v >= arg}[key])
        elif key == "pattern" and kinds["string"]:
            wrong(not re.search(arg.replace("+$", r"+\Z"), v))
        elif key == "maxLength" and kinds["string"]:
            wrong(len(v) > arg)
        elif key in ("minItems", "maxItems") and kinds["array"]:
            wrong(len(v) < arg if key == "minItems" else len(v) > arg)
        elif key == "uniqueItems" and kinds["array"]:
            wrong(len(set(v)) < len(v))
        elif key == "items" and kinds["array"]:
            for k, x in enumerate(v):
                out += judge(arg, x, (*path, k))
        elif key == "maxProperties" and kinds["object"]:
            wrong(len(v) > arg)
        elif key == "required" and kinds["object"]:
            for name in arg:
                wrong(name not in v)
        elif key == "properties" and kinds["object"]:
            for name, one in arg.items():
                out += judge(one, v[name], (*path, name)) if name in v else []
        elif key == "additionalProperties" and kinds["object"]:
            for name in v.keys() - schema.get("properties", {}).keys():
                out += judge(arg, v[name], (*path, name)) if arg else [(*path, name)]
    return out


def values(n=400):
    rng = random.Random(8)
    word = lambda: rng.choice([None, "a", "ab", "abcd", "b", "z", "A", "a\n", "$", "", "ünï"])
    some = lambda f, most: rng.choice([None, [f() for _ in range(rng.randint(0, most))]])
    num = lambda: rng.choice([None, 0.0, -1.0, 1.5, 2.0, 7.0])
    whole = lambda: rng.choice([None, 0, 1, 2, 4, 5])
    return [(word(), num(), whole(), rng.choice([None, True, False]), some(word, 4), rng.choice([None, {"x": word(), "y": num()}]), rng.choice([None, {k: whole() for k in rng.sample(["a", "b", "c"], rng.randint(0, 3))}]), some(lambda: rng.choice([None, {"k": word(), "v": some(whole, 3)}]), 3)) for _ in range(n)]


def test_compiled_rules_find_what_a_judge_finds(spark):
    rows = values()
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "id int, " + COLUMNS)
    found = df.select("id", F.explode(S.errors(SCHEMA, df.drop("id").schema)).alias("e")).select("id", "e.path").collect()
    got = sorted((r["id"], "/".join(str(x["name"] if x["at"] is None else x["at"]) for x in r["path"])) for r in found)
    names = [c.split()[0] for c in ("s", "n", "i", "b", "l", "o", "m", "d")]
    want = sorted((k, "/".join(map(str, p))) for k, r in enumerate(rows) for p in judge(SCHEMA["items"], dict(zip(names, r, strict=True))))
    assert len({p.split("/")[0] for _, p in want}) == 8
    assert got == want


WRONG = [
    {"type": "text"}, {"type": []}, {"type": ["string", "string"]}, {"minimum": "1"}, {"minimum": True}, {"minLength": -1}, {"minItems": 1.5}, {"pattern": "("}, {"pattern": 3},
    {"required": "a"}, {"required": ["a", "a"]}, {"enum": "x"}, {"enum": [[1]]}, {"properties": []}, {"properties": {"a": 1}}, {"items": [{}]}, {"anyOf": []}, {"anyOf": {}}, {"uniqueItems": 1},
    {"$ref": 1}, {"$ref": "#/$defs/none"}, {"$ref": "http://x/y"}, {"$ref": "#"}, {"$defs": {"a": {"$ref": "#/$defs/b"}, "b": {"allOf": [{"$ref": "#/$defs/a"}]}}}, {"if": {}}, {"patternProperties": {}}, [], "x", None,
    {"items": {"properties": {"a": {"items": {"type": 7}}}}},
]


@pytest.mark.parametrize("schema", WRONG, ids=json.dumps)
def test_wrong_schemas_are_refused(schema):
    with pytest.raises(S.SchemaError, match="schema: "):
        S.check_schema(schema)


def test_faults_are_named_where_they_are():
    with pytest.raises(S.SchemaError, match=r"/items/properties/a/type: wrong value 7; /items/maximum: wrong value \"9\""):
        S.check_schema({"items": {"properties": {"a": {"type": 7}}, "maximum": "9"}})
    S.check_schema(profile_schema())
    S.check_schema({"$defs": {"tree": {"properties": {"left": {"$ref": "#/$defs/tree"}}}}, "$ref": "#/$defs/tree"})


def test_what_columns_cannot_show_is_refused(spark):
    df = spark.sql("SELECT parse_json('1') AS v, array(map('a', 1)) AS m")
    for schema in ({"properties": {"v": {"type": "number"}}}, {"properties": {"m": {"uniqueItems": True}}}, {"type": "string"}, {"type": "array", "items": {"anyOf": [{}]}}, {"type": "array", "items": True}):
        with pytest.raises(S.SchemaError):
            S.errors(schema, df.schema)


@pytest.mark.parametrize(("pattern", "java"), [("^a$", r"^a\z"), (r"a\$", r"a\$"), ("[$]$", r"[$]\z"), (r"[\]$]", r"[\]$]"), (r"\\$", r"\\\z"), ("[]$]$", r"[]$]\z")])
def test_end_of_patterns(pattern, java):
    assert S.java_pattern(pattern) == java


CANDIDATES = [("cand_" + f"{k:032x}", f"p{k}@x.io") for k in range(40)]


def people(spark, **more):
    text = "CAST(NULL AS string)"
    made = {
        "candidate_id": "id", "full_name": "'A'", "emails": "array(mail)", "phones": "array('+14155552671')", "location": f"struct({text} AS city, {text} AS region, 'US' AS country)",
        "links": f"struct({text} AS linkedin, {text} AS github, {text} AS portfolio)", "headline": text, "years_experience": "1.0D", "skills": "array('C')",
        "experience": f"array(struct('F' AS company, {text} AS title, '2020-01' AS start_date, {text} AS end_date, {text} AS description))",
        "education": f"array(struct('U' AS institution, {text} AS degree, {text} AS field_of_study, {text} AS start_date, {text} AS end_date))",
        "provenance": f"map('emails', array(struct('csv' AS source, 'x' AS source_id, 'm' AS extraction_method, {text} AS original_field, parse_json('[1]') AS value)))",
        "confidence": "struct(0.5D AS emails)", "overall_confidence": "0.5D",
    } | more
    rows = spark.createDataFrame(CANDIDATES, "id string, mail string").repartition(3)
    return rows.select(*[F.expr(e).alias(n) for n, e in made.items()])


def test_report_numbers_rows_and_items(spark):
    validate_canonical(people(spark))
    spoilt = people(
        spark,
        experience="transform(sequence(0, 11), k -> struct(CASE WHEN id = 'cand_0000000000000000000000000000000c' AND k IN (2, 10) THEN NULL ELSE 'F' END AS company, CAST(NULL AS string) AS title, '2020-01' AS start_date, CASE WHEN id = 'cand_00000000000000000000000000000003' THEN '2020' END AS end_date, CAST(NULL AS string) AS description))",
        overall_confidence="CASE WHEN id = 'cand_00000000000000000000000000000003' THEN 2.0D ELSE 0.5D END",
    )
    found = canonical_report(spoilt).collect()
    want = [f"3/experience/{k}/end_date" for k in range(12)] + ["3/overall_confidence", "12/experience/2/company", "12/experience/10/company"]
    assert [r["path"] for r in found] == want
    with pytest.raises(ValidationError, match="invalid output: 3/experience/0/end_date: must match") as raised:
        validate_canonical(spoilt)
    assert str(raised.value).count(";") == 9
    assert {r["path"] for r in violations(spoilt).collect()} == {"experience/end_date", "overall_confidence", "experience/company"}


def test_missing_and_unknown_columns(spark):
    assert [r["path"] for r in canonical_report(people(spark).drop("skills").limit(1)).collect()] == ["0"]
    assert [r["path"] for r in canonical_report(people(spark).withColumn("more", F.lit(1)).limit(1)).collect()] == ["0/more"]
    assert canonical_report(people(spark).limit(0)).count() == 0


def test_projected_schema_follows_the_policy(spark):
    settings = {"fields": ("candidate_id", "skills", "emails"), "rename": {"emails": "mail"}, "include_confidence": False, "include_provenance": False}
    item = {p: projected_schema(ProjectionConfig(**settings, missing_value_policy=p))["items"] for p in ("null", "omit", "error")}
    assert [list(x["properties"]) for x in item.values()] == [["candidate_id", "skills", "mail"]] * 3
    assert [x["required"] for x in item.values()] == [["candidate_id", "skills", "mail"], [], ["candidate_id", "skills", "mail"]]
    assert item["null"]["properties"]["mail"]["anyOf"][1] == {"type": "null"} and item["omit"]["properties"]["mail"]["type"] == "array"
    none = people(spark, skills="CAST(array() AS array<string>)")
    for policy in ("null", "omit"):
        validate_projected(none, ProjectionConfig(**settings, missing_value_policy=policy))
    with pytest.raises(ValidationError, match="0/mail: must not repeat values"):
        validate_projected(people(spark, emails="array(mail, mail)"), ProjectionConfig(**settings))


def test_engine_takes_a_schema_file(spark, tmp_path):
    stricter = profile_schema()
    stricter["items"]["properties"]["emails"]["items"]["pattern"] = "@example[.]com$"
    (tmp_path / "s.json").write_text(json.dumps(stricter, indent=1))
    (tmp_path / "p.json").write_text(json.dumps([{"name": "Ada Lovelace", "email": "ada@example.com"}]))
    (tmp_path / "q.json").write_text(json.dumps([{"name": "Ada Lovelace", "email": "ada@example.org"}]))
    engine = Engine(spark, schema=f"{tmp_path}/s.json")
    assert engine.run(ats=[f"{tmp_path}/p.json"]).count() == 1
    with pytest.raises(ValidationError, match="0/emails/0: must match @example"):
        engine.run(ats=[f"{tmp_path}/q.json"])
    for text in ("{", '{"type": "lost"}', "[]", ""):
        (tmp_path / "bad.json").write_text(text)
        with pytest.raises(S.SchemaError):
            Engine(spark, schema=f"{tmp_path}/bad.json")
