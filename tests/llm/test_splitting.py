import random

from hypothesis import given, settings
from hypothesis import strategies as st

from verbarium.llm import splitting, tokens

ENC = tokens.encoding()
SIZE = lambda t: len(ENC.encode_ordinary(t))


def check(text, most, overlap):
    pieces = splitting.split_text(text, most, overlap, ENC)
    if SIZE(text) <= most:
        assert pieces == []
        return pieces
    assert "".join(text[f:e] for _, f, e, _ in pieces) == text
    before = None
    for s, f, e, n in pieces:
        assert n == SIZE(text[s:e]) and n <= most and e > f
        if before is None:
            assert s == f == 0
        else:
            assert before[0] <= s <= f == before[2]
            if overlap and s > before[0] and e - f > 1:
                assert SIZE(text[s:f]) >= min(overlap, most - 1)
        before = (s, f, e)
    return pieces


PAGE = "# Title\n\nIntro sentence one. Intro two!\n\n## First\n\n" + "A long line of plain words that goes on. " * 30 + "\n\n- item one\n- item two\n\n## Second\n\n" + "Short.\n" * 40


def test_cuts_at_boundaries():
    pieces = check(PAGE, 120, 0)
    starts = [PAGE[f : f + 8] for _, f, _, _ in pieces]
    assert any(x.startswith("## First") for x in starts) and any(x.startswith("## Secon") for x in starts)
    for _, f, _, _ in pieces[1:]:
        assert PAGE[f - 1] in " \n"


def test_overlap_is_the_end_of_the_piece_before():
    pieces = check(PAGE, 100, 20)
    for before, (s, f, _, _) in zip(pieces, pieces[1:]):
        assert s < f and (SIZE(PAGE[s:f]) >= 20 or s == before[0])


MARKED = """# Top

Intro text.

```python
# x is no heading
def f():

    return 1
```

- one
  - one a
    with more
  - one b
- two

| a | b |
|---|---|
| 1 | 2 |

Setext title
---
<ul>
<li>first <div>inner</div></li>
<li>second</li>
</ul>
tail of it
## Deep

last words
"""


def leaves(n, depth=0):
    if not n.children:
        yield n.kind, depth, n
    at = n.a
    for c in n.children:
        assert c.a == at and c.b > c.a
        at = c.b
        yield from leaves(c, depth + 1)
    assert not n.children or at == n.b


def test_tree():
    found = [(k, MARKED[n.a : n.b].strip()) for k, _, n in leaves(splitting.parse(MARKED))]
    assert ("code", "```python\n# x is no heading\ndef f():\n\n    return 1\n```") in found
    assert ("heading", "# Top") in found and ("heading", "Setext title\n---") in found and ("heading", "## Deep") in found
    assert ("table", "| a | b |\n|---|---|\n| 1 | 2 |") in found
    assert ("item", "- one b") in found and ("item", "- one a\n    with more") in found and ("item", "- two") in found
    assert any("<div>inner</div>" == t for _, t in found) and any(t == "<li>second</li>" for _, t in found)
    depth = {MARKED[n.a : n.b].strip(): d for _, d, n in leaves(splitting.parse(MARKED))}
    assert depth["- one b"] > depth["- two"]


def test_no_cut_inside_a_fence_that_fits():
    rng = random.Random(4)
    fence = "```\n" + "".join(f"# line {i}\n\n" for i in range(8)) + "```\n"
    nested = "".join(f"- item {i}\n" + "".join(f"  - sub {i} {j} with some words\n" for j in range(3)) for i in range(12))
    for _ in range(20):
        parts = [rng.choice([fence, nested, "Some plain words here. " * rng.randrange(1, 20) + "\n", f"## Part {rng.random()}\n"]) for _ in range(12)]
        text = "\n".join(parts)
        most = SIZE(fence) + 40
        pieces = check(text, most, 20)
        cuts = {f for _, f, _, _ in pieces[1:]}
        at = -1
        while (at := text.find(fence, at + 1)) >= 0:
            assert not any(at < c < at + len(fence) for c in cuts)
    only = check(nested, 60, 0)
    assert all(nested[f:].startswith("-") for _, f, _, _ in only)  # whole items first, their sub-items with them


def test_counts_are_exact():
    rng = random.Random(12)
    for _ in range(60):
        text = "".join(rng.choice(["word ", "a1 b", " 12 ", "  ", "\n", "é語", "don't ", "x_y", ", ", "Ünï ", "½ a"]) for _ in range(rng.randrange(2, 120)))
        t = splitting._Text(text, ENC)
        for _ in range(20):
            a, b = sorted(rng.randrange(len(text) + 1) for _ in range(2))
            assert t.count(a, b) == SIZE(text[a:b])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["# a", "## b", "```", "~~~", "- i", "  - j", "1. k", "| c | d |", "<div>", "</div>", "<p>x</p>", "<li>", "text", "a b. C d.", "", "===", "---", "\t"]), max_size=30))
def test_any_tree_tiles_its_text(lines):
    text = "\n".join(lines)
    root = splitting.parse(text)
    assert (root.a, root.b) == (0, len(text))
    list(leaves(root))


def test_edge_texts():
    assert splitting.split_text(None, 10, 2, ENC) == [] and splitting.split_text("", 10, 2, ENC) == [] and splitting.split_text("x", 0, 0, ENC) == []
    check("x" * 20_000, 50, 10)
    check("\n" * 3000, 16, 4)
    check("語" * 500, 16, 5)
    check("🙂🙃" * 200, 12, 3)
    check("<|endoftext|> " * 60, 30, 5)
    check("word " * 50_000, 256, 32)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab c.\n#-é語🙂!?", min_size=30, max_size=400), st.integers(4, 40), st.integers(0, 12))
def test_random_texts(text, most, overlap):
    check(text, most, min(overlap, most // 2))


def test_query_form(spark):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "beta.", "gamma\n\n"]) for _ in range(rng.randrange(0, 300))), "p") for i in range(30)] + [(90, None, "p"), (91, "", "p")]
    d = spark.createDataFrame(docs, "doc_id long, text string, profile string")
    p = spark.createDataFrame([("s", 50, 10), ("m", 100, None), ("none", None, 5)], "profile string, max_tokens int, overlap_tokens int")
    rows = splitting.split_oversized(d, "doc_id", "text", p).collect()
    for i, t, _ in docs:
        for name, most in (("s", 50), ("m", 100)):
            own = sorted((r for r in rows if r.doc_id == i and r.profile == name), key=lambda r: r.piece_no)
            assert bool(own) == (t is not None and SIZE(t) > most)
            assert [r.piece_no for r in own] == list(range(1, len(own) + 1))
            if own:
                assert "".join(t[r.fresh : r.end] for r in own) == t and all(r.piece == t[r.start : r.end] for r in own)
    assert splitting.split_oversized(d.limit(0), "doc_id", "text", p).count() == 0 == splitting.split_oversized(d, "doc_id", "text", p.limit(0)).count()
