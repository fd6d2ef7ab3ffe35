"""HTML extraction, conversation repair and spelling groups against brute force on small rows."""
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from retailq.llm import conversation_repair, html_extraction, spelling_groups

# ---- HTML extraction --------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, host string, path string, text string, held long"
LONG = "An ordinary paragraph with enough words to stand for the main text of a page. "


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a='</p><p>no';</script></head><body>{body}</body></html>"


def extracted(spark, rows) -> list:
    pages = spark.createDataFrame([(*r, "h", "p", "t", 7) for r in rows], PAGES).repartition(3)
    return sorted(((r.page_id, r.url, r.text, r.n_chars) for r in html_extraction.extract_pages(pages).collect()), key=repr)


def one(spark, body: str) -> str:
    (row,) = extracted(spark, [(1, None, body)])
    assert row[3] == len(row[2])
    return row[2]


def test_parts_that_are_not_the_article(spark):
    junk = ('<nav><ul><li><a href="/x">Menu</a></li></ul></nav><header>Head</header><div class="ad big">Buy</div><aside>Side</aside>'
            '<div class="cookie-notice">We use cookies</div><form><p>Your mail</p><input value="v"><button>Go</button></form>'
            '<div id="comments"><article><p>A reader says</p></article></div><div hidden>hidden</div><!-- <p>comment</p> --><footer>&copy; Foot')
    body = page(f"<article><h1>Title</h1><p>{LONG}</p><p>More &lt;b&gt; &amp; caf&eacute;&nbsp;&#x41;.</p></article>{junk}")
    assert one(spark, body) == f"Title {LONG.strip()} More <b> & café A."


def test_open_elements_inline_markup_and_white_space(spark):
    body = page(f"<article><h1>A &am</h1><p><b>un<i>clos</i>ed\n\t bold<br>line<p>next <a href='/>'>li\nnk</a>,\x0bend<ul><li>one<li>two</ul>"
                f"<table><tr><td>c1<td>c2</table><pre> x  y </pre>{LONG}")
    assert one(spark, body) == f"A &am unclosed bold line next li nk , end one two c1 c2 x y {LONG.strip()}".replace("nk ,", "nk,")


def test_null_empty_plain_long_and_repeated_pages(spark):
    many = "".join(f"<p>{LONG}{i}</p>" for i in range(20000))
    rows = [(1, None, None), (2, "x", ""), (3, "http://h/", "only plain   text"), (4, "http://h/", "<" * 1000), (4, "http://h/", "<" * 1000),
            (None, "not a url", page(f"<p>{LONG}</p>")), (5, "https://u@LONG.example:8/x", page(f"<div>{many}</div>"))]
    got = extracted(spark, rows)
    text = {r[0]: r[2] for r in got}
    assert len(got) == len(rows) and text[1] == text[2] == "" and text[3] == "only plain text" and text[None] == LONG.strip()
    assert text[5] == " ".join(f"{LONG}{i}" for i in range(20000))
    assert html_extraction.extract_pages(spark.createDataFrame([], PAGES)).collect() == []


def test_consensus_overrules_a_page_and_falls_back(spark):
    usual = [(i, f"http://News.example/{i}?q", page(f'<div class="story n{i}"><p>{LONG * 3}{i}</p></div><div class="list"><p>short</p></div>'))
             for i in range(6)]
    odd = (7, "https://news.example:80/odd", page(f'<div class="story n7"><p>The short story.</p></div><div class="list"><p>{LONG * 5}</p></div>'))
    other = (8, "http://news.example/other", page(f"<main><p>{LONG}</p></main>"))
    alone = (9, "http://else.example/odd", odd[2])
    text = {r[0]: r[2] for r in extracted(spark, [*usual, odd, other, alone])}
    assert text[7] == "The short story." and text[8] == LONG.strip() and text[9] == (LONG * 5).strip()
    assert text[3] == f"{LONG * 3}3"


def test_votes_ties_and_paths(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b/1", page(f"<div class='x9 b2'><p>{LONG}</p></div>"), *"hpt", 1),
         (2, "http://a.b/2", page(f"<div class='y'><p>{LONG}{LONG}</p></div>"), *"hpt", 1), (3, None, page(f"<p>{LONG}</p>"), *"hpt", 1)], PAGES)
    assert [tuple(r) for r in html_extraction.host_paths(pages).collect()] == [("a.b", "html>body>div.y")]
    assert html_extraction.vote_of(page(f"<div class='x9 b2'><p>{LONG}</p></div>"))[0] == "html>body>div.b.x"


# ---- conversation repair ----------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, part int, chunk int, line string, n long"


def harmed(conv_id, rows):
    out = []
    for turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, f"{r[1]}:{r[2]}".encode(), r[1]))


def reviewed(rows):
    """gaps, blank, duplicate, truncated, illegal and the fault of every row."""
    seen, found = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        found.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, found.count("blank"), found.count("duplicate"),
            found.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))), found


def every_repair(rows, found, inserts):
    """All edit sequences with up to ``inserts`` insertions before each row and behind the last: (cost, audit, lines)."""
    added = [p for k in range(inserts + 1) for p in itertools.product(("user", "assistant"), repeat=k)]
    for before in itertools.product(added, repeat=len(rows) + 1):
        for edits in itertools.product("DKRS", repeat=len(rows)):  # R: to user, S: to assistant
            if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, found)):
                continue
            cost, audit, roles, lines = 0, "", "", []
            for i in range(len(rows) + 1):
                for role in before[i]:
                    cost, audit, roles = cost + 2, audit + "I", roles + role[0]
                    lines.append(f"{role}:")
                if i == len(rows):
                    continue
                (_, role, text), edit = rows[i], edits[i]
                audit += "R" if edit == "S" else edit
                if edit == "D":
                    cost += 3
                    continue
                new = {"K": role, "R": "user", "S": "assistant"}[edit]
                cost += (edit != "K") * 2 + (found[i] == "truncated")
                roles += new[:1] or "-"
                lines.append(f"{new}:{text}")
            if re.fullmatch("(s?(ua)+)?", roles):
                yield cost, audit, lines


def forward(rows, found):
    """Least (cost, audit, lines) by a plain forward table; for conversations too long for all sequences."""
    best = {"": (0, "", ())}

    def filled(table):
        while True:
            new = dict(table)
            for s, (cost, audit, lines) in table.items():
                to = "a" if s == "u" else "u"
                way = (cost + 2, audit + "I", (*lines, "user:" if to == "u" else "assistant:"))
                if to not in new or way < new[to]:
                    new[to] = way
            if new == table:
                return table
            table = new

    for (_, role, text), fault in zip(rows, found):
        table = defaultdict(list)
        for s, (cost, audit, lines) in filled(best).items():
            table[s].append((cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[:1] in {"": "su", "s": "u", "u": "a", "a": "u"}[s]:
                    table[role[:1]].append((cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                to = "a" if s == "u" else "u"
                table[to].append((cost + 2 + extra, audit + "R", (*lines, ("user:" if to == "u" else "assistant:") + text)))
        best = {s: min(ways) for s, ways in table.items()}
    best = filled(best)
    return min(best[s] for s in ("", "a") if s in best)


def seal(lines):
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_edit_lattice_against_all_sequences():
    rng = random.Random(5)
    for _ in range(60):
        rows = sorted(((None, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Yes.", "no", " ", "Ok!"]))
                       for _ in range(rng.randint(1, 3))), key=lambda r: (f"{r[1]}:{r[2]}", r[1]))
        _, found = reviewed(rows)
        best = min(every_repair(rows, found, 2), key=lambda w: w[:2])
        held, seen = [], set()
        for (turn, role, text), copies in Counter(rows).items():
            held.append(conversation_repair.Row(turn, role, f"{role}:{text}", copies, (role, text) not in seen))
            seen.add((role, text))
        got = conversation_repair.solve(held)
        assert (got["cost"], got["audit"], got["repaired_sha256"]) == (best[0], best[1], seal(best[2]))
        assert forward(rows, found)[:2] == best[:2]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "assistant", "user", "system", "tool", "", None], ["Yes.", "no", " ", "", "Ok! ", "Why?\n", None, "a.b", "x" * 5000 + "."]
    rows = [(None if i == 12 else i, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts)) for i in range(13) for _ in range(rng.randint(1, 30))]
    rows += [(20, t, "user" if t % 2 == 0 else "assistant", f"Line {t}.") for t in range(300)]  # a long one
    rows += [(21, 3, "user", "Same.")] * 50 + [(21, None, "user", "Same.")] * 5
    return rows


@pytest.mark.parametrize("chunk_rows", [2, 7, 2048])
def test_conversations_against_a_plain_table(spark, turns, chunk_rows):
    df = spark.createDataFrame([(*t, 1, 2, "l", 3) for t in turns], TURNS).repartition(5)
    got = {r.conv_id: tuple(r)[1:] for r in conversation_repair.repair_conversations(df, chunk_rows=chunk_rows).collect()}
    groups = defaultdict(list)
    for conv_id, *row in turns:
        groups[conv_id].append(tuple(row))
    assert got.keys() == groups.keys()
    for conv_id, rows in groups.items():
        rows = harmed(conv_id, rows)
        counts, found = reviewed(rows)
        cost, audit, lines = forward(rows, found)
        assert got[conv_id] == (*counts, cost, audit, seal(lines)), conv_id


def test_conversations_empty_and_all_dropped(spark):
    assert conversation_repair.repair_conversations(spark.createDataFrame([], TURNS)).collect() == []
    dropped = next(t for t in range(1000) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    (row,) = conversation_repair.repair_conversations(spark.createDataFrame([(1, dropped, "user", "x", 1, 2, "l", 3)], TURNS)).collect()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", seal([]))


# ---- spelling groups --------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, word string, n long, length int, leaf int, form string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    forms, out = {}, []
    for w, n in words.items():
        about = [x for x in words if near(w, x)]
        best = min(about, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best and words[best] >= 10 * n else None
        out.append((w, n, len(about)))
    rows = set()
    for w, n, k in out:
        root = w
        while forms[root]:
            root = forms[root]
        rows.add((w, forms[w], root, n, k, words[forms[w]] if forms[w] else None))
    return rows


@pytest.fixture(scope="module")
def spellings():
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcdeéÀÿ÷z") for _ in range(rng.randint(6, 10))) for _ in range(40)]
    words = []
    for stem in stems:
        words += [stem] * rng.choice([3, 40, 450])
        for _ in range(6):
            at, letter = rng.randrange(len(stem)), rng.choice("abcxé")
            changed = rng.choice([stem[:at] + letter + stem[at + 1:], stem[:at] + letter + stem[at:], stem[:at] + stem[at + 1:], stem[:at] + stem[at:][::-1]])
            words += [changed] * rng.choice([1, 2, 4, 40])
    words += ["MIXEDcase", "mixedcase", "É" * 9, "é" * 9, "q" * 3000, "q" * 3000, "q" * 2999 + "r", "q" * 2999 + "r"]
    rng.shuffle(words)
    rows = [(i // 7 if i % 50 else None, ("; 1 ".join(words[i:i + 9]))) for i in range(0, len(words), 9)]
    return rows + [(1, None), (2, ""), (3, "short wœrds only"), (4, rows[0][1]), (4, rows[0][1])]


@pytest.mark.parametrize("limits", [dict(), dict(leaf_words=8, max_leaves=16), dict(leaf_words=20, max_leaves=3, shard_bytes=60)])
def test_spellings_against_all_pairs(spark, spellings, limits):
    docs = spark.createDataFrame([(*r, "w", 1, 2, 3, "f") for r in spellings], DOCS).repartition(4)
    got = spelling_groups.group_spellings(docs, **limits)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert Counter(tuple(r) for r in got.collect()) == Counter(grouped(spellings))


def test_spellings_chain_and_empty(spark):
    counts = {"wordings": 2000, "wordinga": 150, "wordingab": 12}
    unharmed = next(i for i in range(99) if all(zlib.crc32(f"{i}:{w}".encode()) % 31 for w in counts))
    clean = [(unharmed, w) for w, n in counts.items() for _ in range(n)]
    docs = spark.createDataFrame([(*r, "w", 1, 2, 3, "f") for r in clean], DOCS)
    got = {r.word: (r.form, r.root) for r in spelling_groups.group_spellings(docs).collect()}
    assert got == {v[0]: v[1:3] for v in grouped(clean)}
    assert got["wordingab"] == ("wordinga", "wordings")
    assert spelling_groups.group_spellings(spark.createDataFrame([], DOCS)).collect() == []


def test_damage_in_spark_is_the_rule(spark):
    rows = [(i, f"language{chr(97 + i % 26)}é") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, run string").select("doc_id", "run", spelling_groups.damaged(F.col("doc_id"), F.col("run")).alias("w"))
    for r in df.collect():
        h = zlib.crc32(f"{r.doc_id}:{r.run}".encode())
        assert r.w == (r.run[:h % len(r.run)] + r.run[h % len(r.run) + 1:] if h % 31 == 0 else r.run)


# ---- earlier operators ------------------------------------------------------------------------------------------

def test_shard_draws_recomputed(spark):
    """Region, rack and shard of every key from its draws, computed again in Python."""
    import math

    import xxhash

    from retailq.llm import sharding
    tree = tuple(sharding.Shard(s.region, s.rack, s.shard, 1.0 + s.shard % 3) for s in sharding.uniform_tree(3, 2, 4))

    def pick(key, weights):
        draw = lambda name: -math.log(((xxhash.xxh64_intdigest(f"{key}|{name}".encode(), seed=42) >> 11) + 0.5) * 2.0 ** -53) / weights[name]
        return min(sorted(weights), key=lambda name: (draw(name), name))

    def place(key):
        below = lambda prefix: [s for s in tree if prefix(s)]
        region = pick(key, {r: sum(s.weight for s in below(lambda s: s.region == r)) for r in {s.region for s in tree}})
        rack = pick(key, {k: sum(s.weight for s in below(lambda s: s.rack == k)) for k in {s.rack for s in tree if s.region == region}})
        leaf = pick(key, {f"{rack}/shard{s.shard}": s.weight for s in tree if s.rack == rack})
        return int(leaf.rsplit("shard", 1)[1])

    keys = [str(i) for i in range(300)] + ["null", "", "é", "a b"]
    got = sharding.place(spark.createDataFrame([(k,) for k in keys], "key string"), "key", tree, "shard").collect()
    assert {r.key: r.shard for r in got} == {k: place(k) for k in keys}


def test_equal_vectors_are_each_a_candidate(spark):
    import math

    from retailq.llm import vector_search
    rows = ([(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [1.0, 0.1]), (3, [1.0, 0.1]), (4, None), (5, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [float("nan"), 1.0])]
            + [(2, [1.0, 0.2])] * 4 + [(100, [5.0, 5.0])] * 2)
    df = spark.createDataFrame([(*r, 1, 2, 0.5, 9) for r in rows], "vec_id long, embedding array<double>, shard int, dim int, score double, rank int").repartition(3)
    ok = [(i, v) for i, v in rows if i is not None and v and all(map(math.isfinite, v)) and any(v)]
    want = []
    for q in (0, 100):
        own = min(v for i, v in ok if i == q)
        near = sorted((math.dist(own, v), i) for i, v in ok if i != q)[:6]
        want += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    for per_shard in (2, 4096):
        got = vector_search.nearest(df, df.where(F.col("vec_id") % 100 == 0), k=6, rows_per_shard=per_shard).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, round(r.score, 12)) for r in got) == [(a, b, c, round(d, 12)) for a, b, c, d in want]


def test_language_held_out(spark):
    from retailq.llm import queries
    sf = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in queries.op8_language_id(spark, sf).collect() if r.held_out and langs[r.doc_id]]
    right = sum(r.lang_pred == langs[r.doc_id] for r in held)
    assert len(held) > 200 and right >= 0.98 * len(held)
