"""Repair of texts: each step against a plain reading of it, character by character."""

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyspark.operators import repair as R

NAMED = {"\t": "\\t", "\n": "\\n", "\r": "\\r", "\b": "\\b", "\f": "\\f"}


def escaped_plainly(text):
    out, quoted, after_backslash = "", False, False
    for c in text:
        if not quoted:
            quoted = c == '"'
            out += c
        elif after_backslash:
            after_backslash = False
            out += c
        elif c in '\\"':
            after_backslash, quoted = c == "\\", c != '"'
            out += c
        else:
            out += NAMED.get(c) or (f"\\u{ord(c):04x}" if c < " " else c)
    return out


@settings(max_examples=500, deadline=None)
@given(st.text('"\\\x00\n\t\x1fnu{}a,', max_size=14))
def test_escaping_against_a_plain_reading(text):
    assert R.escape_controls(text) == escaped_plainly(text)


@pytest.mark.parametrize(("text", "value"), [('{"a":"x\x00ny"}', {"a": "x\x00ny"}), ('{"a":"x\ty"}', {"a": "x\ty"}), ('{"a":"\\"\n"}', {"a": '"\n'})])
def test_escaped_texts_keep_their_values(text, value):
    assert json.loads(R.escape_controls(text)) == value


def test_a_backslash_before_a_raw_control_stays_broken():
    assert R.recover('{"a":"x\\\ty"}', "standings")["success"] is False


@settings(max_examples=300, deadline=None)
@given(st.recursive(st.one_of(st.integers(0, 9), st.text("ab]}\"", max_size=3)), lambda x: st.one_of(st.lists(x, max_size=3), st.dictionaries(st.text("k", max_size=2), x, max_size=3)), max_leaves=8), st.text("]},\n ", max_size=4))
def test_extra_and_missing_closers(value, tail):
    text = json.dumps([value])
    assert json.loads(R.trim_extra_closers(text + tail)) == [value]
    cut = text.rstrip("]}")
    closers = R.missing_closers(cut)
    if closers is not None and text[len(cut) :] == closers:
        assert json.loads(cut + closers) == [value]
    assert R.missing_closers(text) is None


def test_other_steps():
    assert R.drop_trailing_commas('[{"a": 1, } , ]') == '[{"a": 1} ]'
    assert R.close_empty_arrays('{"a": [ } ]}') == '{"a": []}'
    assert R.recover(None or "", "games") == {"category": "UNSUPPORTED", "success": False, "recovery_rule": None, "parse_error": None, "recovered": None}
    assert json.loads(R.recover("{'a': (1, None)}", "rosters")["recovered"]) == {"a": [1, None]}
