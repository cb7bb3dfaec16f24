"""The header reader against a YAML loader on a fixture, random headers, and its errors."""

import datetime as dt
import json
import random

import pytest

from quarry.functions.yaml import YamlError, load

yaml = pytest.importorskip("yaml")

HEADERS = {
    "flat": "title: A b c\nauthor: x y # who\ndate: 2024-03-29 16:00:49+00:00\nn: 12\nempty:\nnothing: ~\n",
    "nested": "a:\n  b:\n    c: 1\n    d: [x, y]\n  e: 2\nf: 3",
    "lists": "tags:\n  - one\n  - two\nsame:\n- 1\n- 2\nof maps:\n  - name: a\n    n: 1\n  - name: b\n    deep:\n      - - x\n        - y\n      -\n        k: v\n",
    "flow": "a: [1, 2.5, 'q, r', \"s: t\", [x, {y: z}], u: v]\nb: {k: v, l: [1, 2], m: , 'n o': ~}\nc: [\n  1, # one\n  2,\n  ]\nd: {}\ne: []",
    "quoted": "a: 'it''s'\nb: \"tab\\t\\u00e9 \\x41 \\\"q\\\"\"\nc: 'two\n  lines\n\n  and'\nd: \"fold\n  ed \\\n  on\"\n'e f': 1\n\"g\": 2",
    "literal": "a: |\n  one\n    two\n\n  three\nb: |-\n  x\n\nc: |+\n  y\n\nd: |2\n   z\ne: end",
    "folded": "a: >\n  one\n  two\n\n  three\n    deep\n    deeper\n  four\nb: >-\n  x\n  y\nc: >+\n  z\n\nd: 1",
    "plain lines": "a: one\n  two\n\n  three\nb: http://x.y/z?q=1#frag\nc: a#b\nd: - dash\ne: x: y" if False else "a: one\n  two\n\n  three\nb: http://x.y/z?q=1#frag\nc: a#b\n",
    "anchors": "base: &b\n  x: 1\n  y: 2\none:\n  <<: *b\n  y: 3\ntwo: *b\nl: &l [1, 2]\nm: *l\nk:\n  <<: [*b, {z: 9}]\ns: &s text\nt: *s",
    "scalars": "a: yes\nb: Off\nc: 0x1F\nd: 010\ne: 1_000\nf: 1e3\ng: 1.5e+3\nh: -7\ni: +3\nj: 0b11\nk: 'yes'\nl: NULL\nm: 1:30\nn: .5\no: 1.\np: !!str 12",
    "comments": "# top\na: 1 # one\n\n# between\nb:\n  # inside\n  c: 2\n# after\nd: 'x' # y\n# end",
    "list on top": "- a\n- b: 1\n  c: 2\n-\n- [x]\n",
    "scalar on top": "just words\n  and more",
    "empty": "\n# nothing\n",
    "keys": "a b: 1\nc-d: 2\n1: x\nü: ß\n\"q: r\": 3\nurl: a:b:c\n",
    "repeated": "a: 1\na: 2\n",
    "properties": "a: &x\n  b: 1\nc: &y\n- 1\nd: [&z 1, *z]\ne: !!map\n  f: 1\nlist:\n  - &i\n    k: 1\n  - &j k: 2\n  - *i\n",
}


def plain(value):
    """As JSON has it: keys are texts, times are texts."""
    if isinstance(value, dict):
        return {"null" if k is None else str(k).lower() if isinstance(k, bool) else str(k): plain(v) for k, v in value.items()}
    if isinstance(value, list):
        return [plain(v) for v in value]
    return value


@pytest.mark.parametrize("name", HEADERS)
def test_equal_to_a_loader(name):
    want = plain(yaml.safe_load(HEADERS[name]))
    got = load(HEADERS[name])
    if name == "flat":
        assert got.pop("date") == "2024-03-29 16:00:49+00:00" and isinstance(want.pop("date"), dt.datetime)
    assert got == want
    json.dumps(got)


@pytest.mark.parametrize("text", ["a: 1\n\tb: 2", "? x\n: y", "a: *nobody", "a: [1, 2", "a: 'open", "a: 1\n  b: 2", "a:\n  b: 1\n c: 2", "<<: 3",
                                  "---\na: 1", "a: \"\\q\"", "a: {x: 1} y", "[" * 500, "\n".join("  " * i + "a:" for i in range(300)),
                                  "a0: &a0 [x, x]\n" + "\n".join(f"a{i}: &a{i} [{', '.join([f'*a{i - 1}'] * 9)}]" for i in range(1, 9))])
def test_errors(text):
    with pytest.raises(YamlError):
        load(text)


def test_random_values_survive_a_dump():
    r = random.Random(4)

    def value(depth):
        kind = r.random()
        if depth < 4 and kind < 0.25:
            return {f"k{r.randint(0, 20)}": value(depth + 1) for _ in range(r.randint(0, 4))}
        if depth < 4 and kind < 0.45:
            return [value(depth + 1) for _ in range(r.randint(0, 4))]
        return r.choice([None, True, False, 0, -5, 10 ** 12, 1.5, -0.25, "", "x", "yes", "12", "a: b", "a #b", "#c", " lead", "trail ", "it's", 'say "x"',
                         "two\nlines", "two\n\nlines\n", "- dash", "éü", "tab\there", "[x", "{y", "*z", "&w", "!t", "%p", "@q", "`r`", "null", "~",
                         "long " * 40, "2024-01-01", "1:30", "=", "|", ">", "?", "-", ":", "a:", "x,y"])

    for i in range(1500):
        one = {f"key{j}": value(0) for j in range(r.randint(1, 4))}
        text = yaml.safe_dump(one, default_flow_style=r.choice([None, True, False]), allow_unicode=r.random() < 0.5, width=r.choice([20, 80]),
                              indent=r.choice([2, 4]), default_style=r.choice([None, None, None, "'", '"', "|", ">"]))
        try:
            assert load(text) == plain(yaml.safe_load(text)), text
        except YamlError as e:
            raise AssertionError(f"{e}\n{text}") from e
