from hypothesis import given, settings
from hypothesis import strategies as st

from strataforge.operators import textplan as T


def test_front_matter():
    assert T.front_matter("no fields\n---\n") == ({}, "no fields\n---\n")
    assert T.front_matter("---\na: 1\nnever closed") == ({}, "---\na: 1\nnever closed")
    assert T.front_matter("---\na: \"x y\"\nb: 'z'\na.b: no\n  c: no\na: last\n---\nbody\n") == ({"a": "last", "b": "z"}, "body")


def test_normalise_body():
    assert T.normalise_body("text", "doc") == ("# doc\n\ntext\n", ["Inserted missing H1 heading.", "No source markers found in body."])
    body, warnings = T.normalise_body("# A\r\n\r\n\r\n\r\n\r\n#B  \r\n# C\r\n```\r\n#x\r\n# y\r\n```\r\n[source 1]", "doc")
    assert body == "# A\n\n\n## B\n## C\n```\n#x\n# y\n```\n[source 1]\n" and warnings == []


MIXED = "# Head\n\n```\n# no heading\n\n```\n> quote\n> more\n| a | b |\n| - | - |\n- item\n  goes on\n1. one\nplain\nstill plain\n\n## Sub\nlast"


def test_blocks():
    assert [b.kind for b in T.blocks(MIXED)] == ["heading", "code", "blockquote", "table", "list", "paragraph", "heading", "paragraph"]
    assert [b.start for b in T.blocks(MIXED)] == [1, 1, 2, 3, 4, 5, 6, 6]


def words(n, w="w"):
    return " ".join(f"{w}{i}" for i in range(n))


def test_pieces_of_long_blocks():
    assert [len(c.content.split()) for c in T.plan_chunks(words(700))] == [500, 200]
    text = f"Short one. {words(600)}. Short two."
    kept = [c.content.split()[0] for c in T.plan_chunks(text)]
    assert kept[0] == "Short" and "".join(c.content for c in T.plan_chunks(text)).split() == text.split()
    parity = [b.text.split()[0] for b in T.pieces(T.Block("paragraph", text, 1, 1), T.Rules(parity=True))]
    assert parity[0] == "w0" and parity[-1] == "Short"


def test_tables_and_code_stay_whole_unless_asked():
    table = "\n".join(f"| {words(60)} |" for _ in range(10))
    assert len(T.plan_chunks(table)) == 1
    assert len(T.plan_chunks(table, T.Rules(split_tables=True))) > 1


def test_chunks_close_at_target_and_before_maximum():
    got = T.plan_chunks("\n\n".join([words(200), words(150), words(290), words(300)]))
    assert [(c.tokens, c.start, c.end) for c in got] == [(350, 1, 2), (290, 3, 3), (300, 4, 4)]


def test_chapters():
    preamble, found, level = T.chapters("# Top\nintro\n## A\nx\n### deep\n```\n## no\n```\n## B\n## C\ny")
    assert level == 2 and [c.title for c in found] == ["A", "B", "C"] and preamble == ["# Top", "intro"]
    assert len(T.chapters("```\n# a\n```\n# b\n# c", parity=True)[1]) == 3
    assert T.split_level([1, 2, 2, 2]) == 2 and T.split_level([1, 3]) == 1 and T.split_level([]) == 1
    _, found, _ = T.chapters("## A\none\n# Above\ntwo\n## B\nthree", level=2)
    assert [(c.number, c.lines) for c in found] == [(1, ["one"]), (2, ["three"])]


def test_sections():
    assert T.sections("x\n# A\n1\n# B\n2") == [("", "x\n"), ("A", "# A\n1\n"), ("B", "# B\n2\n")]


line = st.sampled_from(["", "# H", "## S", "text one. Two!", "- item", "  more", "> q", "| a | b |", "```", "1. n", words(40), words(130) + "."])


@settings(max_examples=150, deadline=None)
@given(st.lists(line, max_size=40))
def test_chunking_keeps_every_token_in_order(lines):
    text = "\n".join(lines)
    rules = T.Rules(target=60, maximum=100)
    got = T.plan_chunks(text, rules)
    assert " ".join(c.content for c in got).split() == text.split()
    assert all(c.tokens == len(c.content.split()) for c in got)
    assert all(a.end <= b.start for a, b in zip(got, got[1:], strict=False))
    assert "".join("".join(b.text.split()) for b in T.blocks(text)) == "".join(text.split())
