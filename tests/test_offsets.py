from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tidemark.functions.offset_lines import parse_offset_lines, range_text
from tidemark.operators.offset_ranges import lowest_deltas, ranges_by_topic, report_lines, topic_stats, write_report
from tidemark.plans import jobs
from tidemark.sources.text import numbered, read_lines, split_lines


def line(partition, start, end, topic="t1"):
    return f"topic: {topic}    partition: {partition}    offsets: {start} to {end}"


def file_lines():
    """27 lines: eight decide the smallest deltas, the others have deltas of 17 and once 23."""
    lines = [line(100 + i, 1000, 1000 + (23 if i == 1 else 17)) for i in range(1, 28)]
    decisive = {
        2: (16, 1173931, 1173935),
        4: (17, 1115880, 1115881),
        10: (63, 1108270, 1108271),
        12: (45, 1188388, 1188389),
        19: (48, 1300960, 1300961),
        23: (55, 1164431, 1164436),
        24: (58, 1288124, 1288205),
        26: (0, 1121323, 1121328),
    }
    for number, values in decisive.items():
        lines[number - 1] = line(*values)
    return lines


def parse(spark, text, strict=True):
    block = spark.createDataFrame([(text,)], "text string")
    return parse_offset_lines(split_lines(block, "text"), strict=strict)


def values(df):
    fields = ("topic", "partition", "from_offset", "until_offset", "delta")
    return [tuple(r[f] for f in fields) for r in df.orderBy("line_no").collect()]


def test_file(spark, tmp_path):
    path = tmp_path / "ranges.txt"
    path.write_text("\n".join(file_lines()[:5] + ["", ""] + file_lines()[5:]))
    result = jobs.offset_report(spark, str(path))
    assert result["stats"].collect() == [("t1", 27, 1, 81, 15)]
    assert result["ranges"].agg(F.sum("delta")).first()[0] == 428
    lowest = result["lowest"].withColumn("text", range_text()).orderBy("rank").collect()
    assert [(r.rank, r.delta, r.partition, r.text) for r in lowest] == [
        (1, 1, 48, "1300960 -> 1300961 = 1"),
        (2, 4, 16, "1173931 -> 1173935 = 4"),
        (3, 5, 0, "1121323 -> 1121328 = 5"),
    ]
    report = [r.line for r in result["report"].orderBy("topic", "section", "position").collect()]
    assert len(report) == 1 + 27 + 1 + 3
    assert report[0] == "t1"
    assert report[2] == "\t16-> 1173931 -> 1173935 = 4"
    assert report[28] == "t1 统计: count=27, minDelta=1, maxDelta=81, averageDelta=15"
    assert report[29] == "\t最小Delta 1 : 1300960 -> 1300961 = 1"


def test_literal(spark):
    ends = [(3, 2681068463, 2681087213), (19, 1283781919, 1283800669), (4, 2166322545, 2166341295)]
    ranges = parse(spark, "\n".join(line(*e) for e in ends))
    assert values(ranges) == [("t1", p, a, b, 18750) for p, a, b in ends]
    assert topic_stats(ranges).collect() == [("t1", 3, 18750, 18750, 18750)]
    assert lowest_deltas(ranges).count() == 0


def test_lines_that_are_kept(spark):
    text = "\n".join(
        [
            "",
            "topic: t1    partition: 1",
            "topic: t1    partition: 1    offsets: 1 to 2    more: 3",
            "topic: t1    partition: 1    offsets: 1 to 2    ",
            "topic: t1    partition: 1    offsets: 1 to 2     ",
            "\tTOPIC : t2    Partition:2    offsets: 5to9\r",
            "topic: t3:cut    colour: red    offsets: 7 to 8 to 9",
            "colour: red    partition: 4    size: 1",
            "topic: first    topic: last    partition: 6",
        ]
    )
    assert values(parse(spark, text)) == [
        ("t1", 1, 1, 2, 1),
        ("t2", 2, 5, 9, 4),
        ("t3", 0, 7, 8, 1),
        (None, 4, 0, 0, 0),
        ("last", 6, 0, 0, 0),
    ]


@pytest.mark.parametrize(
    "bad, lenient",
    [
        ("topic: t    partition: x    offsets: 1 to 2", ("t", None, 1, 2, 1)),
        ("topic: t    partition: 1    offsets: 1 to x", ("t", 1, 1, None, None)),
        ("topic: t    partition: 1    offsets: 5", ("t", 1, 5, None, None)),
        ("topic:    partition: 1    offsets: 1 to 2", (None, 1, 1, 2, 1)),
        ("topic: t    partition: 99999999999    offsets: 1 to 2", ("t", None, 1, 2, 1)),
        ("topic    partition: 1    offsets: 1 to 2", (None, 1, 1, 2, 1)),
    ],
)
def test_bad_values(spark, bad, lenient):
    assert values(parse(spark, bad, strict=False)) == [lenient]
    with pytest.raises(Exception):
        parse(spark, bad).collect()


def test_plain_lines_are_read_as_the_rules_say(spark):
    """A trailing separator takes a line off the plain path without changing what it says."""
    lines = [line(0, 0, 0), line(999999999, 10**18 - 1, 1, "é-t_1."), line("007", "09", "010"), line(3, 5, 2, "to")]
    plain, ruled = (values(parse(spark, "\n".join(x + end for x in lines))) for end in ("", "    "))
    assert plain == ruled and plain[1] == ("é-t_1.", 999999999, 10**18 - 1, 1, 2 - 10**18)
    # One digit more than the plain path takes.
    wide = [line(1000000000, 1, 2), line(1, 10**18, 10**18 + 1)]
    assert [v[1:3] for v in values(parse(spark, "\n".join(wide)))] == [(1000000000, 1), (1, 10**18)]


def test_average_is_cut_towards_zero(spark):
    ranges = parse(spark, "\n".join([line(1, 10, 5), line(2, 10, 8)]))
    assert topic_stats(ranges).first().avg_delta == -3


def test_lowest_needs_a_fourth(spark):
    three = [line(p, 0, d) for p, d in enumerate([5, 6, 7, 7])]
    assert lowest_deltas(parse(spark, "\n".join(three))).count() == 0
    four = three + [line(9, 0, 90)] + [line(p, 0, 5, "t2") for p in range(4)]
    found = lowest_deltas(parse(spark, "\n".join(four))).orderBy("rank").collect()
    assert [(r.topic, r.delta, r.partition) for r in found] == [("t1", 5, 0), ("t1", 6, 1), ("t1", 7, 3)]


def test_lists_hold_all_ranges_in_order(spark):
    ranges = parse(spark, "\n".join(line(i, 0, i, f"t{i % 2}") for i in range(100)))
    listed = ranges_by_topic(ranges).collect()
    assert [(r.topic, r.partition) for r in listed] == [(t, i) for t in ("t0", "t1") for i in range(100) if f"t{i % 2}" == t]


def test_lists_of_several_blocks_are_whole(spark):
    blocks = [["\n".join(line(100 * b + i, 0, i) for i in range(50))] for b in range(3)]
    ranges = parse_offset_lines(split_lines(spark.createDataFrame(blocks, "value string"), "value"))
    listed = ranges_by_topic(ranges).collect()
    assert [(r.line_no, r.partition) for r in listed] == [(i, 100 * b + i) for i in range(50) for b in range(3)]


def test_report_has_sections_per_topic(spark):
    ranges = parse(spark, "\n".join([line(1, 0, 5), line(2, 0, 5, "t2")]))
    report = report_lines(ranges).orderBy("topic", "section", "position").collect()
    assert [(r.topic, r.section) for r in report] == [(t, s) for t in ("t1", "t2") for s in (0, 1, 2)]


@pytest.mark.parametrize("split_bytes", ["64", "700", "128m"])
def test_lines_of_many_files_are_in_order(spark, tmp_path, split_bytes):
    """Files of very different sizes, so that tasks read parts of several; names with blanks and signs."""
    folder = tmp_path / "some lines"
    folder.mkdir()
    written = []
    for i, (name, count) in enumerate([("b%20.txt", 3), ("a é.txt", 200), ("c.txt", 1), ("b.txt", 70), ("d#.txt", 40)]):
        texts = [f"{name} line {j}" if (j + i) % 5 else "" for j in range(count)]
        (folder / name).write_text("\n".join(texts) + "\n")
        written.append((name, texts))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        ordered = [t for _, texts in sorted(written, key=lambda x: quote(x[0])) for t in texts]
        assert [r.value for r in read_lines(spark, str(folder)).orderBy("line_no").collect()] == [t for t in ordered if t]
        assert [tuple(r) for r in numbered(spark, str(folder)).orderBy("line_no").collect()] == list(enumerate(ordered))
        one = read_lines(spark, str(folder / "a é.txt")).orderBy("line_no").collect()
        assert [r.value for r in one] == [t for t in dict(written)["a é.txt"] if t]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split_bytes", ["200", "128m"])
def test_last_line_wins_over_files(spark, tmp_path, split_bytes):
    folder = tmp_path / "files"
    folder.mkdir()
    for f in range(4):
        lines = [f"topic: t    partition: {100 * f + i}    offsets: {1000 * f + i} to {1000 * f + i + i % 5}" for i in range(30)]
        (folder / f"part-{f}.txt").write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        found = jobs.offset_report(spark, str(folder))
        lowest = found["lowest"].orderBy("rank").collect()
        write_report(found["report"], str(tmp_path / "report"))
        report = [r.value for r in numbered(spark, str(tmp_path / "report")).orderBy("line_no").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.delta, r.partition) for r in lowest] == [(0, 325), (1, 326), (2, 327)]
    assert report[0] == "t" and report[1].startswith("\t0-> 0 -> 0 = 0") and report[120].startswith("\t329-> ")
    assert "count=120" in report[121] and report[122].endswith("3025 -> 3025 = 0") and len(report) == 125
