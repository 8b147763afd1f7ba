"""Structure repair, fill-in-middle and URL filter against brute force."""

import hashlib
import itertools
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import middles, repair, url_filter

# --- structure repair ---------------------------------------------------------------

GOOD = re.compile(r"(s?(ua)+)?")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how:
            text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
            out += [(conv, turn, "user" if how == 4 else role, text)] * (2 if how == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def every_repair(rows, found, inserts):
    """All edit sequences with up to `inserts` inserts in a row: (cost, audit, repaired)."""
    said = [("I", 5, "user:"), ("I", 5, "assistant:")]
    gap = [x for n in range(inserts + 1) for x in itertools.product(said, repeat=n)]
    ways = [[(0, "", ())]]
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        more = 5 if fault == "truncated" else 0
        own = [("D", 2, None)]
        if fault in ("", "truncated"):
            own += [("K", more, f"{role}:{text}"), ("R", 1 + more, f"user:{text}"), ("R", 1 + more, f"assistant:{text}")]
        ways.append([(sum(c for _, c, _ in [*g, o]), "".join(e for e, _, _ in [*g, o]), tuple(t for _, _, t in [*g, o] if t is not None)) for g in gap for o in own])
    ways.append([(sum(c for _, c, _ in g), "I" * len(g), tuple(t for _, _, t in g)) for g in gap])
    for parts in itertools.product(*ways):
        lines = [t for p in parts for t in p[2]]
        if GOOD.fullmatch("".join(t.split(":", 1)[0][:1] or "-" for t in lines)):
            yield sum(p[0] for p in parts), "".join(p[1] for p in parts), "\n".join(lines)


def walked(rows, found):
    """The same by a plain program over rows and four states, with whole strings."""
    def inserts(s):
        out = dict(s)
        for _ in range(3):
            for (i, c), j in repair.SAY.items():
                if c != "s" and i in out:
                    cost, audit, lines = out[i]
                    out[j] = min(out.get(j, (math.inf,)), (cost + 5, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[c])))
        return out

    state = {repair.EMPTY: (0, "", ())}
    for (_, _, role, text), fault in zip(rows, found, strict=True):
        state, after = inserts(state), {}
        for i, (cost, audit, lines) in state.items():
            own = [(2, "D", i, ())]
            if fault in ("", "truncated"):
                more = 5 if fault == "truncated" else 0
                if (i, role[:1]) in repair.SAY:
                    own.append((more, "K", repair.SAY[i, role[:1]], (f"{role}:{text}",)))
                own += [(1 + more, "R", repair.SAY[i, c], (f"{name}:{text}",)) for c, name in (("u", "user"), ("a", "assistant")) if (i, c) in repair.SAY]
            for c, e, j, more_lines in own:
                after[j] = min(after.get(j, (math.inf,)), (cost + c, audit + e, lines + more_lines))
        state = after
    state = inserts(state)
    cost, audit, lines = min(state[s] for s in (repair.EMPTY, repair.ASSISTANT) if s in state)
    return cost, audit, "\n".join(lines)


def expected(conv, rows, best):
    rows = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], sha(r[3])))
    found = faults(rows)
    cost, audit, text = best(rows, found)
    turns = [r[1] for r in rows if r[1] is not None]
    initials = [r[2][:1] for r in rows]
    return (
        conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(found.count(k) for k in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, sha(text),
    )


SCHEMA = "conv_id long, turn long, role string, text string, conv string, n string"


def talk(seed, lengths):
    rnd = random.Random(seed)
    texts = ["Yes.", "No?", "cut off", "", " \t", "So it is! ", "well\n", "Once more.", None]
    rows = []
    for conv, n in enumerate(lengths):
        rows += [(conv, None if rnd.random() < 0.1 else rnd.randint(0, n), rnd.choice(["system", "user", "assistant", "user", "assistant", "tool", None, ""]), rnd.choice(texts)) for _ in range(n)]
    return rows


def test_matrices_equal_all_edit_sequences():
    rnd = random.Random(3)
    for _ in range(60):
        rows = [(0, k, rnd.choice(["system", "user", "assistant", "tool"]), rnd.choice(["Yes.", "no", "", "So?"])) for k in range(rnd.randint(0, 3))]
        found = faults(rows)
        best = min(every_repair(rows, found, 2))
        assert walked(rows, found) == best


def test_repair_equals_brute_force(spark):
    rows = talk(1, [0, 1, 1, 2, 3, 5, 8, 8, 8, 13, 40, 300])
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (99, 7, "assistant", "Same.")] + [(50, 1, "user", "Twice.")] * 40
    rows += [(60, k, "ua"[k % 2] == "u" and "user" or "assistant", f"Word {k}.") for k in range(3000)]  # several blocks
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = {tuple(r) for r in repair.repair_query(df).collect()}
    after = damaged(rows)
    assert got == {expected(c, after, walked) for c in {r[0] for r in rows}}


def test_repair_gives_the_rows_of_its_digest(spark):
    df = spark.createDataFrame([(*r, "x", "y") for r in talk(2, [4, 9, 30])], SCHEMA)
    lines = {}
    for r in repair.repair(repair.damage(df)).where("place IS NOT NULL").orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for r in repair.repair_query(df).collect():
        text = "\n".join(lines.get(r.conv_id, []))
        assert r.repaired_sha256 == sha(text) and GOOD.fullmatch("".join(x[0] for x in lines.get(r.conv_id, [])))


def test_a_conversation_whose_rows_all_go(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, gone, "user", "Hi.", "", "")], SCHEMA)
    assert [tuple(r) for r in repair.repair_query(df).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert repair.repair_query(df.limit(0)).count() == 0


def test_grammar_shares_products_and_stays_exact(spark):
    blocks = spark.createDataFrame([("UA" * n,) for n in (1, 2, 4, 8, 16)] + [("SUAuaUx",), ("U",)], "block string")
    grammar = repair.learn_grammar(blocks)
    assert grammar.rules[0] == "UA" and len(grammar.parsed("UA" * 16)) <= 2
    plain = repair.Grammar([])
    for r in blocks.collect():
        own, want = grammar.matrix(r.block), plain.matrix(r.block)
        assert [m and (m[0], repair.flat(m[1])) for m in own] == [m and (m[0], repair.flat(m[1])) for m in want]


# --- fill-in-middle -----------------------------------------------------------------


def middle_of(doc, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), sha(f"1:{'' if doc is None else doc}")
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text))


def test_middles_equal_brute_force(spark):
    rnd = random.Random(4)
    texts = [None, "", "a", "<", "<<P", "<P>", "x<S>y", "é", "日本 語 text\n\n", "\U0001f600a\U0001f600", "word " * 200_000, "<P<S<M" * 9]
    texts += ["".join(rnd.choice("ab Zé<>PSM\n漢1") for _ in range(rnd.randint(0, 60))) for _ in range(300)]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "same id", "x", 1), (3, "same id", "x", 1), (None, "no id", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, output string, n long")
    key = lambda r: str(r)
    got = sorted((tuple(r) for r in middles.middles_query(df).select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()), key=key)
    assert got == sorted((middle_of(r[0], r[1]) for r in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    out = middles.to_middles(df)
    assert out.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output"]
    back = middles.from_middles(out)
    assert back.where(~F.coalesce("text", F.lit("")).eqNullSafe(F.col("restored"))).count() == 0
    assert middles.middles_query(df.limit(0)).count() == 0


def test_rotation_by_three_reversals(monkeypatch):
    import numpy as np

    monkeypatch.setattr(middles, "SWAP", 3)
    for n in range(20):
        for cut in range(n + 1):
            block = bytearray(range(n))
            middles.rotate(np.frombuffer(block, np.uint8), cut)
            assert bytes(block) == bytes(range(n))[cut:] + bytes(range(n))[:cut]


# --- URL filter -----------------------------------------------------------------------

LOW = {c: c + 32 for c in range(65, 91)}


def split(url):
    found = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (found[1].translate(LOW), found[2]) if found else ("", "")


def brute_verdicts(pages, rules):
    judged = []
    for i, url, html in pages:
        host, path = split(url)
        fit = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        r = max(fit, key=lambda r: len(r.name), default=None)
        judged.append((i, host, path, r))
    edges = {}
    for (_, _, html), (_, src, _, _) in zip(pages, judged, strict=True):
        for dst in {u.translate(LOW) for u in re.findall(r"""(?i)[\s"']href\s*=\s*["']?(?:https?:)?//([^/?#"'<>\x00-\x20]+)""", html or "")}:
            if src and src != dst:
                edges[src, dst] = edges.get((src, dst), 0) + 1
    hosts = {h for _, h, _, _ in judged if h}
    mine = {h: [r.verdict if r else None for _, x, _, r in judged if x == h] for h in hosts}
    scores = {}
    for kind, verdict, way in (("trust", "allow", edges), ("distrust", "block", {(b, a): n for (a, b), n in edges.items()})):
        start = {h: 1.0 for h in hosts if 2 * mine[h].count(verdict) > len(mine[h])}
        out = {}
        for (a, _), n in way.items():
            out[a] = out.get(a, 0) + n
        r = dict(start)
        for _ in range(math.ceil(math.log(0.01) / math.log(0.85)) if edges else 0):
            new = dict(start)
            for (a, b), n in way.items():
                if a in r:
                    new[b] = new.get(b, 0) + 0.85 * r[a] * n / out[a]
            r = new
        total = sum(r.values())
        scores[kind] = {h: round(x / total, 9) for h, x in r.items()}
    known = set(scores["trust"]) | set(scores["distrust"])
    t, d = (lambda h: scores["trust"].get(h, 0)), (lambda h: scores["distrust"].get(h, 0))
    bad = {h for h in known if d(h) > t(h) and d(h) >= round(0.5 / len(known), 9)}
    return sorted((i, h, p, r.name if r else None, r.verdict if r else "block" if h in bad else "allow") for i, h, p, r in judged)


def link_pages():
    rnd = random.Random(8)
    good, bad, plain = [f"g{k}.org" for k in range(5)], [f"b{k}.net" for k in range(5)], [f"n{k}.com" for k in range(12)]
    pages = []
    for i in range(160):
        host = rnd.choice(good + bad + plain)
        # the first plain hosts lead to blocked ones, the others to good ones
        to = rnd.choice(bad if host in plain[:4] else good if host in plain[4:8] else good + plain[4:8] if host in good else bad + plain)
        form = rnd.choice(['<a href="http://{0}/x">', "<A HREF=//{1}>", "<a class='c' href = 'HTTPS://{0}?q'>"])
        path = "/fr/1" if host in good else rnd.choice(["/en/2", "/de/3?x", "", "/fr#t"])
        pages.append((i, f"https://{host}{path}", "<p>" + form.format(to, to.upper()) * rnd.randint(0, 3) + '<a href="/own">'))
    pages += [(900, None, "<a href='//g1.org/'>"), (901, "no scheme", None), (902, "http://", ""), (903, "HTTP://WWW.Example.COM/de/x", None), (904, "http://a.example.net/en/?q", ""), (904, "http://a.example.net/en/?q", "")]
    pages += [(910, "http://net/", ""), (911, "http://xnet/", ""), (912, "http://a.net", ""), (913, "http://a.net?x/", ""), (914, "ftp://org/fr/://b", "")]
    return pages


def test_url_filter_equals_brute_force(spark):
    pages = link_pages()
    df = spark.createDataFrame([(*p, "clash", "clash") for p in pages], "page_id long, url string, html string, host string, verdict string")
    got = sorted(tuple(r) for r in url_filter.judge_urls(df).collect())
    want = brute_verdicts(pages, url_filter.RULES)
    assert sorted(got, key=str) == sorted(want, key=str)
    free = {h: v for _, h, _, r, v in got if r is None}
    assert {free.get(f"n{k}.com") for k in range(4)} <= {"block", None} and {free.get(f"n{k}.com") for k in range(4, 8)} <= {"allow", None}
    assert url_filter.judge_urls(df.limit(0)).count() == 0


def test_url_filter_without_links(spark):
    df = spark.createDataFrame([(1, "http://a.net/x", None), (2, "http://a.net", ""), (3, "http://a.net/y", None), (4, "http://c.com/", "<p>")], "page_id long, url string, html string")
    assert {r.page_id: r.verdict for r in url_filter.judge_urls(df).collect()} == {1: "block", 2: "block", 3: "block", 4: "allow"}


def test_rules_are_read_and_checked():
    assert [r.name for r in url_filter.RULES] == ["net/", "example.net/en/", "example.com/de/", "org/fr/"]
    with pytest.raises(ValueError):
        url_filter.parse_rules(["maybe net/"])
