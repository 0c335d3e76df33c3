import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import json as js
from tidemark.plans import jobs

GOOD = {
    '{"a":1}': {"a": 1},
    '{"a":1,"timeMillis":5}': {"a": 1, "timeMillis": 5},
    '{"b":{"c":[1,2]},"a":1.5}': {"a": 1.5, "b": {"c": [1, 2]}},
    ' {"a":1} ': {"a": 1},
    "{a:1}": {"a": 1},
    "{'a':'x'}": {"a": "x"},
    '{"a":1,"a":2}': {"a": 2},
    "{}": {},
}
BAD = ["bad", "", "null", "[1,2]", '{"a":1} x', '{"a":1}}', '{"a":1},{"b":2}', '{"a":1},"~end~"', "7", '"text"', '{"a":']


def lines(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def parsed(spark, texts, column):
    return [r[0] for r in js.with_json_object(lines(spark, texts)).select(column).collect()]


def test_strict(spark):
    texts = parsed(spark, list(GOOD), F.to_json(js.strict_object()))
    assert [json.loads(t) for t in texts] == list(GOOD.values())


@pytest.mark.parametrize("text", [*BAD, None])
def test_strict_fails(spark, text):
    with pytest.raises(Exception, match="not a JSON object"):
        parsed(spark, [text], F.to_json(js.strict_object()))


def test_fallback(spark):
    texts = parsed(spark, [*GOOD, *BAD], js.json_or_line())
    assert [json.loads(t) for t in texts] == [*GOOD.values(), *[{"line": t} for t in BAD]]


def test_normalise(spark):
    texts = [r.value for r in jobs.normalised(lines(spark, [*GOOD, *BAD])).collect()]
    assert [json.loads(t) for t in texts[: len(GOOD)]] == list(GOOD.values())
    assert texts[len(GOOD) :] == [""] * len(BAD)


@pytest.mark.parametrize(
    "text, kept",
    [
        ('{"a": 1.10}', '{"a":1.10}'),
        ('{"a": 1.0, "b": 1E5}', '{"a":1.0,"b":1E5}'),
        ('{"a": ' + "1" * 45 + "}", '{"a":' + "1" * 45 + "}"),
        ('{"a": 0.' + "3" * 43 + "}", '{"a":0.' + "3" * 43 + "}"),
        ('{ "b" : "x  \\" : y" ,\t"a":[ 1 , {"c": null} ] }\n', '{"b":"x  \\" : y","a":[1,{"c":null}]}'),
        ("{'a': 1.10}", '{"a":1.1}'),
        ("{a: " + "1" * 45 + "}", None),
        ('{"a": NaN}', None),
        ('{"a": "NaN"}', '{"a":"NaN"}'),
        ('{"a": "it\'s", "b": "x: y"}', '{"a":"it\'s","b":"x: y"}'),
    ],
)
def test_text_keeps_its_numbers(spark, text, kept):
    assert parsed(spark, [text], js.json_or_line()) == [kept if kept is not None else json.dumps({"line": text}, separators=(",", ":"))]
    assert parsed(spark, [text], js.json_or_empty()) == [kept or ""]


def test_stamp_replaces_the_field(spark):
    rows = jobs.stamped(lines(spark, list(GOOD)), strict=True, now_ms=F.lit(1700000000123)).collect()
    assert [r.stamp_ms for r in rows] == [1700000000123] * len(GOOD)
    assert rows[0].event_time.microsecond == 123000
    texts = jobs.stamped(lines(spark, list(GOOD)), strict=True, now_ms=F.lit(7)).select(F.to_json("fields")).collect()
    assert [json.loads(r[0]) for r in texts] == [{**v, "timeMillis": 7} for v in GOOD.values()]


def random_object(rng, depth=0):
    names = ['"a"', '"t"', '"b,c"', '"\\u0074"', '"t\\u0074"', '""', '"x\\"t"', '"{t"', '"T"']
    numbers = ["1.10", "1E5", "null", "true", '"a,b"', '"x\\"}{,"', '"t"', '"\\\\"', '""', "1" * 45]

    def value():
        kind = rng.random() if depth < 3 else 1
        if kind < 0.25:
            return random_object(rng, depth + 1)
        if kind < 0.4:
            return "[" + ",".join(rng.choice([random_object(rng, depth + 1), '"t"', "2"]) for _ in range(rng.randint(0, 3))) + "]"
        return rng.choice(numbers)

    return "{" + ",".join(f"{rng.choice(names)}:{value()}" for _ in range(rng.randint(0, 4))) + "}"


def pairs(text):
    return json.loads(text, object_pairs_hook=list, parse_float=str, parse_int=str)


def test_text_is_stamped_at_the_top_level_only(spark):
    rng = random.Random(1)
    texts = [random_object(rng) for _ in range(800)] + ["{}", '{"t":1}', '{"t":1,"t":2}', '{"a":{"t":1}}', '{"a":1,"t":{"t":1}}']
    texts.append('{"a":"' + "x" * 300_000 + '","t":"' + "\\n" * 2000 + '"}')
    got = parsed(spark, texts, js.put_in_text(js.strict_text(), "t", F.lit("7")))
    for text, stamped in zip(texts, got):
        assert pairs(stamped) == [p for p in pairs(text) if p[0] != "t"] + [("t", "7")]
        if '"t"' not in text and "\\" not in text:
            assert stamped == text[:-1] + ("," if len(text) > 2 else "") + '"t":7}'


def test_stamped_text_keeps_its_numbers(spark):
    digits = "1" * 45
    texts = ['{"id":' + digits + ',"x":1.10,"y":1E5}', '{"timeMillis":5, "id":' + digits + "}", "{'a': 1.10}"]
    strict = jobs.stamped(lines(spark, texts), strict=True, now_ms=F.lit(7)).select("value").collect()
    assert [r.value for r in strict] == ['{"id":' + digits + ',"x":1.10,"y":1E5,"timeMillis":7}', '{"id":' + digits + ',"timeMillis":7}', '{"a":1.1,"timeMillis":7}']
    assert parsed(spark, texts[:2], js.strict_text()) == [texts[0], texts[1].replace(" ", "")]
    loose = jobs.stamped(lines(spark, ["bad"]), strict=False, now_ms=F.lit(7)).select("value").collect()
    assert [r.value for r in loose] == ['{"line":"bad","timeMillis":7}']


@pytest.mark.parametrize("text", [*BAD, None])
def test_strict_text_fails(spark, text):
    with pytest.raises(Exception, match="not a JSON object"):
        parsed(spark, [text], js.strict_text())


def test_stamp_is_the_clock_by_default(spark):
    row = jobs.stamped(lines(spark, ["bad"]), strict=False).select("fields", "stamp_ms", F.unix_millis(F.now())).first()
    assert abs(row[1] - row[2]) < 60_000
    assert set(row.fields) == {"line", "timeMillis"}


def test_counts_need_every_line_parsed(spark):
    with pytest.raises(Exception, match="not a JSON object"):
        jobs.salted_counts(lines(spark, ["{}", "bad"]), strict=True).collect()
    tolerant = jobs.salted_counts(lines(spark, ["{}", "bad"]), strict=False, now_ms=F.lit(0)).collect()
    assert sum(r.cnt for r in tolerant) == 2 and sum(r.bad for r in tolerant) == 1
