import random
import re

from conftest import first_plan

from logmill.operators.clean import clean
from logmill.operators.parse import parse, rejects, split_lines
from logmill.schema import FIELDS

# Fixed value: the log format as Python reads it, tied to the start of the line.
FORMAT = re.compile(r'(\S+) (\S+) (\S+) \[(.*?)\] "(\S+) (\S+) (\S+)" (\S+) (\S+) "(.*?)" "(.*?)"')

GOLDEN = [
    '1.2.3.4 - - [22/Jan/2019:03:56:14 +0330] "GET /a HTTP/1.1" 200 10 "-" "UA" "-"',
    '1.2.3.4 - - [] "GET /a HTTP/1.1" 200 - "" ""',
    'x 1.2.3.4 - - [d] "GET /a HTTP/1.1" 200 10 "-" "UA"',
    '1 - - [d] "-" 400 0 "-" "-"',
    '1 - - [d] "GET /a b HTTP/1.1" 200 1 "-" "U"',
    '1 - - [d] "GET /a H" 200 1 "r" "a \\"q\\" b"',
    '1 - - [d] x] "GET /a H" 200 1 "r" "u"',
    "",
    'a b - - [d] "GET /a H" 200 1 "r" "u"',
    '1 - - [d] "GET /a H" 200 1 "r" "u v"',
    '1 - - [a] "b] "GET /a H" 200 1 "r" "u"',
    '1 - - [d] "GET /a" H" 200 1 "r" s" "u" "v"',
    '1 - - [d] "GET /\u0001 H" 200 1 "\u0001" "\u0085"',
]
MATCHED = [True, True, False, False, False, True, True, False, False, True, True, True, True]


def expected(line):
    match = FORMAT.match(line)
    return match.groups() if match else None


def parsed(spark, values):
    rows = split_lines(spark.createDataFrame([(v,) for v in values], "value string")).collect()
    return {r["value"]: None if r["host"] is None else tuple(r[f] for f in FIELDS) for r in rows}


def test_golden_lines(spark):
    got = parsed(spark, GOLDEN)
    assert [got[line] is not None for line in GOLDEN] == MATCHED
    for line in GOLDEN:
        assert got[line] == expected(line), line
    assert got[GOLDEN[1]][3] == "" and got[GOLDEN[1]][8:] == ("-", "", "")
    assert got[GOLDEN[5]][10] == "a \\"
    assert got[GOLDEN[6]][3] == "d] x"


def test_mutated_lines_equal_python(spark):
    rng = random.Random(7)
    pieces = [" ", '"', "[", "]", "-", "a", "] ", '" ', '" "', "\t", " ", " ", "\x1c", "\x85", "é", "\\", "$1"]
    values = set(GOLDEN)
    seeds = [g for g, m in zip(GOLDEN, MATCHED) if m]
    while len(values) < 3000:
        line = list(rng.choice(seeds))
        for _ in range(rng.randint(1, 3)):
            at = rng.randrange(len(line) + 1)
            kind = rng.random()
            if kind < 0.5:
                line[at:at] = rng.choice(pieces)
            elif line[at:]:
                line[at : at + rng.randint(1, 3)] = rng.choice(["", rng.choice(pieces)])
        values.add("".join(line))
    got = parsed(spark, sorted(values))
    wrong = [v for v in values if got[v] != expected(v)]
    assert not wrong
    assert sum(v is not None for v in got.values()) > 300


def test_every_character_is_blank_or_not_as_in_python(spark):
    """Each character of the basic plane once in a word and once in quotes."""
    characters = [chr(c) for c in [*range(1, 0xD800), *range(0xE000, 0x10000), 0x1F600] if chr(c) != "\n"]
    values = [f'a{c}b - - [d] "GET /a H" 200 1 "r" "u"' for c in characters]
    values += [f'a - - [d{c}] "GET /a H" 200 1 "r{c}" "u{c}"' for c in characters]
    got = parsed(spark, values)
    assert [v for v in values if got[v] != expected(v)] == []


def test_no_line_is_lost(lines):
    df = lines(*GOLDEN)
    assert parse(df).count() == sum(MATCHED)
    assert [r["value"] for r in rejects(df).collect()] == [g for g, m in zip(GOLDEN, MATCHED) if not m]


def test_value_with_line_feeds_is_not_a_match(lines):
    df = lines("\n".join(FIELDS), "\n" * 10, GOLDEN[0] + "\n")
    assert parse(df).count() == 1
    assert rejects(df).count() == 2


def test_pattern_runs_once_and_in_the_jvm(lines):
    plan = first_plan(clean(parse(lines(*GOLDEN))))
    assert "Python" not in plan
    assert plan.count("regexp_replace(value") == 1
    assert "RLIKE" not in plan
    assert plan.count("regexp_replace(datetime") == 1
