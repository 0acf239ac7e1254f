import random
import re
from collections import Counter, defaultdict

import pytest

pytest.importorskip("lumenfold.llm")

from lumenfold.llm import line_dedup as L  # noqa: E402


def brute(rows, min_docs, min_copies, depth=3, min_tokens=4):
    tokens = lambda x: [t for t in re.split(L.SPACE, re.sub("[0-9]+", "0", x)) if t]
    leaves, kinds = defaultdict(list), defaultdict(list)
    for doc in {(i, t or "") for i, t in rows}:
        for no, line in enumerate(doc[1].split("\n")):
            if w := tokens(line):
                leaves[len(w), *w[:depth]].append((doc, no, tuple(w)))
                kinds[tuple(w)].append((doc, no))
    texts = lambda members: len({m[0][1] for m in members})
    gone = set()
    for kind, members in kinds.items():
        if texts(members) >= (min_copies if len(kind) >= min_tokens else min_docs):
            gone |= set(members)
    for members in leaves.values():
        n = len(members[0][2])
        if n < min_tokens or texts(members) < min_docs:
            continue
        groups = [members]
        for _ in range(L.ROUNDS):
            groups, todo = [], groups
            for group in todo:
                template = {}
                for p in range(n):
                    token, c = Counter(w[p] for _, _, w in group).most_common(1)[0]
                    if 2 * c > len(group):
                        template[p] = token
                fits = lambda w: 2 * sum(template.get(p) == w[p] for p in range(n)) >= n  # noqa: E731, B023
                general, rest = [m for m in group if fits(m[2])], [m for m in group if not fits(m[2])]
                if texts(general) >= min_docs:
                    gone |= {(d, no) for d, no, _ in general}
                often = [{t: c for t, c in Counter(m[2][p] for m in rest).items() if min_docs <= c < len(rest)} if p >= depth else {} for p in range(n)]
                at = max(range(n), key=lambda p: sum(often[p].values()))  # noqa: B023
                divided = defaultdict(list)
                for m in rest:
                    divided[m[2][at] if not general and m[2][at] in often[at] else None].append(m)
                groups += divided.values()
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for no, x in enumerate(lines) if ((i, t or ""), no) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_equals_brute_force(spark):
    rng = random.Random(8)
    w = lambda n: [rng.choice("abcdefgh") for _ in range(n)]

    def line():
        kind = rng.randrange(6)
        if kind == 0:
            return f"user {rng.randrange(999)} logged in from {rng.choice('xyz')} port {rng.randrange(9)}"
        if kind == 1:
            return "all rights are reserved by us"
        if kind == 2:
            return " ".join(["same", "lead", "here", *w(3)])
        return " \t".join(w(rng.randrange(12)))

    rows = [(i, "\n".join(line() for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(None, None), (None, ""), (3, "all rights are reserved by us\n\n"), (3, "all rights are reserved by us\n\n"), (70, "z " * 40_000), (71, "\n" * 50)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, leaf int, kind string")
    for min_docs, min_copies in ((2, 2), (5, 3), (L.MIN_DOCS, L.MIN_COPIES)):
        got = [tuple(r) for r in L.drop_recurring_lines(spark, docs, min_docs=min_docs, min_copies=min_copies).collect()]
        assert sorted(got, key=str) == sorted(brute(rows, min_docs, min_copies), key=str)


def test_the_defaults_drop_planted_lines_and_leave_copies_whole(spark):
    own = lambda i: " ".join(chr(97 + i % 26) * (i // 26 + j) for j in range(1, 6))
    passage = " ".join(f"word{'x' * i}" for i in range(60))
    rows = [(i, f"{own(i)}\n{passage}") for i in range(3)]  # a long line in three documents
    rows += [(10 + i, f"{own(10 + i)}\nPage {i} of {90 + i} in all") for i in range(3)]  # the same but for digits
    rows += [(20 + i, f"{own(20 + i)}\nAll rights reserved.") for i in range(10)]  # a short line in ten
    rows += [(40 + i, f"{own(40 + i)}\nOh no.") for i in range(9)]  # a short line in nine stays
    rows += [(60 + i, f"posted on the {'uvwxyz'[i % 6] * (i + 1)} board by us") for i in range(12)]  # a template with a variable field
    rows += [(80 + i, "copies of a document\nkeep all of their lines") for i in range(40)]
    got = {r["doc_id"]: (r["kept"], r["n_dropped"]) for r in L.drop_recurring_lines(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        lines = text.split("\n")
        assert got[i] == ((lines[0], 1) if i < 40 and i not in range(60, 72) else ("", 1) if 60 <= i < 72 else (text, 0)), i


def test_a_leaf_has_several_templates(spark):
    word = lambda i, j: chr(97 + i % 26) * (i // 26 + 1) + "xyz"[j]
    first = lambda i: f"conn from host {word(i, 0)} was opened by user {word(i, 1)} today"
    second = lambda i: f"conn from host {word(i, 2)} timed out after many {word(i, 1)} tries"
    third = lambda i: f"conn from host {word(i, 0)} {word(i, 2)} refused: bad key sent"
    noise = lambda i: f"conn from host {' '.join(word(i * 7 + j, j % 3) for j in range(6))}"
    for counts in ((30, 20, 0), (30, 20, 12), (15, 15, 15), (25, 25, 9)):
        lines = [(k, f(i + 40 * k)) for k, f in enumerate((first, second, third)) for i in range(counts[k])] + [(3, noise(i)) for i in range(8)]
        rows = [(i, f"{'own ' * (i + 1)}\n{line}") for i, (_, line) in enumerate(lines)]
        got = {r["doc_id"]: r["n_dropped"] for r in L.drop_recurring_lines(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
        for i, (k, _) in enumerate(lines):
            assert got[i] == (k < 3 and counts[k] >= 10), (counts, i)
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_documents")]


def test_empty_table(spark):
    assert L.drop_recurring_lines(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0
