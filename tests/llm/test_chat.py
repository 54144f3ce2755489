import hashlib
import random

import pytest

from clinicpulse.llm import chat
from clinicpulse.llm.template import Constant, Generation, If, Print, TemplateError, compiled, fold_all, parse, walks_turn_by_turn

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def summaries(spark, rows, schema=SCHEMA):
    out = chat.summaries(chat.rendered(spark.createDataFrame(rows, schema))).collect()
    return {r["conv_id"]: tuple(r)[1:] for r in out}


def expected(turns):
    """``turns``: (role, text) in order."""
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    formatted = "".join(f"{chat.START}{chat.escape_role(r)}\n{chat.escape(t)}{chat.END}\n" for r, t in turns)
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted)


def test_hostile_texts_come_back(spark):
    rng = random.Random(3)
    signs = ["<", "|", "\\", "im_end", "<|im_end|>", "<|im_start|>", "\n", "assistant", "é", "🙂", "<\\|", "n"]
    rows, wanted = [], {}
    for conv in range(300):
        turns = [
            (rng.choice(["user", "assistant", "system", "".join(rng.choices(signs, k=3))]), "".join(rng.choices(signs, k=rng.randint(0, 9))))
            for _ in range(rng.randint(1, 6))
        ]
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
        wanted[conv] = expected(turns)
    rng.shuffle(rows)
    assert summaries(spark, rows) == wanted


def test_nulls_ties_repeats_and_clashing_columns(spark):
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "a"), (1, 0, "assistant", "a"),
            (None, 1, "user", "x"), (None, 0, "assistant", "y")]
    wanted = {1: expected([("user", "first"), ("", ""), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]),
              None: expected([("assistant", "y"), ("user", "x")])}
    assert summaries(spark, rows) == wanted
    wide = [(*r, "f", 3) for r in rows]
    assert summaries(spark, wide, SCHEMA + ", formatted string, part int") == wanted


def test_empty_table(spark):
    assert summaries(spark, []) == {}


def test_a_long_conversation_is_cut_into_parts(spark):
    turns = [(("user", "assistant")[i % 2], f"{i} <|im_end|> " * 20_000) for i in range(12)]
    rows = [(1, i, r, t) for i, (r, t) in enumerate(turns)]
    parts = chat.rendered(spark.createDataFrame(rows, SCHEMA))
    assert parts.count() > 2
    assert summaries(spark, rows) == {1: expected(turns)}


def test_a_hot_conversation_is_rendered_by_many_tasks(spark):
    turns = [(("user", "assistant")[i % 2], f"{i} <|im_end|>\n{chat.START}") for i in range(3000)]
    rows = [(5, i, r, t) for i, (r, t) in enumerate(turns)] + [(c, 0, "user", str(c)) for c in (4, 6, 7)]
    parts = chat.rendered(spark.createDataFrame(rows, SCHEMA))
    assert parts.filter("conv_id = 5").count() > 2 and not parts.filter("not whole").count()
    wanted = {5: expected(turns)} | {c: expected([("user", str(c))]) for c in (4, 6, 7)}
    assert summaries(spark, rows) == wanted


def test_ties_beyond_the_short_keys(spark):
    long = "x" * 64
    turns = [(long, "z"), (long, "a"), (long + "y", "b"), ("x" * 63, "c" * 70 + "2"), ("x" * 63, "c" * 70 + "1"), ("x" * 63, "b")] * 40
    rows = [(1, None, r, t) for r, t in turns]
    assert summaries(spark, rows) == {1: expected(sorted(turns))}


def test_templates_that_do_more_than_walk(spark):
    walk = chat.TEMPLATE
    assert walks_turn_by_turn(walk, chat.FILTERS)
    for other in (walk + "x", "{% if messages %}" + walk + "{% endif %}", "{% for m in messages %}{% if messages %}a{% endif %}{% endfor %}", "a", ""):
        assert not walks_turn_by_turn(other, chat.FILTERS)
    turns = [(("user", "assistant")[i % 2], f"{i} <|im_end|> " * 20_000) for i in range(12)]
    rows = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate(turns)], SCHEMA)
    parts = chat.rendered(rows, template="{% if messages %}" + walk + "{% endif %}")
    assert parts.filter("not whole").count() > 2
    assert [tuple(r) for r in chat.summaries(parts).collect()] == [(1, *expected(turns))]


def test_escape_is_reversible():
    for text in ("", "<|", "<\\|", "<\\\\||", "a<|im_end|>b", "<<||", "\\<|", "|<"):
        assert chat.unescape(chat.escape(text)) == text
        assert chat.END not in chat.escape(text) and chat.START not in chat.escape(text)


def render(source, **values):
    return list(compiled(source, {"up": str.upper})(values))


def test_template_language():
    assert render("a{{ x | up }}b", x="q") == [("a", False), ("Q", False), ("b", False)]
    source = "{% for m in messages %}{% if m.role == 'a' and not m.off %}{% generation %}{{ m.text }}{% endgeneration %}{% elif m.role != 'b' or x %}-{% else %}={% endif %}{% endfor %}"
    messages = [{"role": "a", "text": "t"}, {"role": "a", "off": "1"}, {"role": "b"}, {"role": "c"}]
    assert render(source, messages=messages) == [("t", True), ("-", False), ("=", False), ("-", False)]
    assert render("{{ missing.field }}{{ '\\n' + \"q\" }}") == [("\nq", False)] or render("{{ missing.field }}") == [("", False)]


def test_constants_are_folded():
    nodes = fold_all(parse("a{{ 'b' + 'c' | up }}{% if 'x' == 'y' %}no{% else %}d{% endif %}{% generation %}{{ 'e' }}f{% endgeneration %}"), {"up": str.upper})
    assert nodes == (Print(Constant("abCd")), Generation((Print(Constant("ef")),)))
    assert isinstance(fold_all(parse("{% if x %}1{% endif %}"), {})[0], If)


@pytest.mark.parametrize(
    "source",
    ["{{ x.__class__ }}", "{{ x() }}", "{{ x[0] }}", "{% import os %}", "{{ x | nope }}", "{% if x %}", "{% for a in b %}", "{{ }}",
     "{{ 'a }}", "{{ (x }}", "{% endfor %}", "{{ x y }}", "{% generation 3 %}{% endgeneration %}", "{{ x._hidden }}"],
)
def test_what_the_language_does_not_have(source):
    with pytest.raises(TemplateError):
        compiled(source, {})


def test_only_given_messages_are_walked():
    with pytest.raises(TemplateError):
        render("{% for a in x %}{% endfor %}", x="text")
    assert render("{{ x.real }}{{ x.text }}", x=5) == [("", False), ("", False)]
