import hashlib
import re

import numpy as np

from quayside.llm import secrets
from tests.llm import cases

KINDS = {
    "assign": r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}


def brute(text):
    least = {"assign": 6, "access": 20, "hex": 24}
    order = [*KINDS]
    found = [
        (m.start(), order.index(kind), f"{kind}:{m.start()}:{m.end()}")
        for kind, pattern in KINDS.items()
        for m in re.finditer(pattern, text or "")
        if len(m[2] if kind == "assign" else m[0]) >= least[kind]
    ]
    return [name for _, _, name in sorted(found)]


ODD = [
    "token=token=abcdefgh",
    "secret=token: abcdefgh",
    "TOKEN = ab token=abcdefgh",
    "toKen=abcdefgh paſsword=abcdefgh",
    "api_key:'" + "0" * 30 + "' apikey=\"short\" AKIA123 AKIAAKIA" + "Z" * 20,
    "\U0001f600 passwd  :  a.b/c+d==",
]


def test_base_patterns():
    for text in [*cases.texts(), *ODD]:
        found = [f"{k}:{a}:{b}" for k, a, b in secrets.base_spans(text or "")]
        assert found == brute(text)


def test_documents(spark):
    rows = secrets.op10_secret_scans(spark, cases.TABLES).collect()
    text = {r.doc_id: r.text for r in cases.documents(spark).collect()}
    assert len(rows) == len(text)
    for r in rows:
        base = brute(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert {*base} <= {*r.spans.split(",")} or not base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(b.startswith(k) for b in base) for k in KINDS)


def findings(n, seed=0):
    """Windows of random keys behind an assignment, and of names with numbers."""
    random = np.random.default_rng(seed)
    windows, labels = [], []
    for i in range(n):
        if i % 2:
            value = "".join(random.choice(list("0123456789abcdef"), 40))
            text, start = f'{cases.prose(i, 4)} token = "{value}"', 0
            start = text.index(value)
        else:
            value = f"{cases.prose(i, 1)}.host{i % 9}.example.com"
            text = f"{cases.prose(i, 4)} {value}"
            start = text.index(value)
        windows.append(np.frombuffer(secrets.window(text, start, start + len(value)), np.uint8))
        labels.append(i % 2)
    return np.array(windows), np.array(labels)


def test_the_network_finds_what_no_pattern_does():
    model = secrets.train(*findings(400))
    text = 'the credential "9f8e7d6c-5b4a3928-1706f5e4-d3c2b1a0" and mail3.host7.example.com'
    found = secrets.candidates(text, secrets.base_spans(text))
    scores = model.scores([secrets.window(text, a, b) for a, b in found])
    flagged = [text[a:b] for (a, b), s in zip(found, scores, strict=True) if s >= model.threshold]
    assert flagged == ["9f8e7d6c-5b4a3928-1706f5e4-d3c2b1a0"]
    codes, labels = findings(200, seed=5)
    held = model.scores([c.tobytes() for c in codes]) >= model.threshold
    assert held[labels == 1].mean() >= 0.97 and held[labels == 0].mean() <= 0.02


def test_too_little_to_learn_from():
    codes, labels = findings(200)
    assert secrets.train(codes[:4], labels[:4]) is None
    assert secrets.train(codes[labels == 1], labels[labels == 1]) is None


def test_edges(spark):
    docs = cases.edge_documents(spark)
    for model in (secrets.fit(docs), secrets.train(*findings(400))):
        found = secrets.scanned(docs, model)
        assert found.columns == [*docs.columns, "secret_spans"]
        for r in found.collect():
            own = [f"{s.kind}:{s.start}:{s.end}" for s in r.secret_spans]
            assert [s for s in own if not s.startswith("learned")] == brute(r.text)
        clean = secrets.redacted(docs, model, length="n_chars")
        assert clean.columns == docs.columns
        for r in clean.collect():
            assert not brute(r.text) and (r.text is None or r.n_chars in (len(r.text), None, 1))
    assert secrets.scanned(cases.no_documents(spark), None).count() == 0
    assert [r.secret_spans for r in secrets.scanned(cases.null_documents(spark), None).collect()] == [[]] * 3


def test_overlapping_findings_become_one_mark(spark):
    frame = spark.createDataFrame([(1, 'a token = "' + "0123456789abcdef" * 2 + '" b')], "doc_id long, text string")
    assert [r.text for r in secrets.redacted(frame, None).collect()] == ['a [SECRET]" b']


def test_long_candidates_are_seen_whole(spark):
    model = secrets.train(*findings(400))
    key = "9f8e7d6c-5b4a3928-1706f5e4-d3c2b1a0"
    names = ".".join(f"{cases.prose(i, 1)}.host{i % 9}.example.com" for i in range(6))
    assert len(names) > 2 * secrets.INSIDE
    texts = [f"lomi {names}.{key} sera", f"lomi {names}.{key}.{names} sera", f"lomi {names} sera"]
    frame = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.start, s.end) for s in r.secret_spans] for r in secrets.scanned(frame, model).collect()}
    assert found == {0: [("learned", 5, len(texts[0]) - 5)], 1: [("learned", 5, len(texts[1]) - 5)], 2: []}


def test_windows_cover_a_candidate_and_what_stands_behind_it():
    for n in (16, 40, 41, 60, 61, 100, 1_003):
        text = "before " + "".join(np.random.default_rng(n).choice(list("abcdefghij0123456789"), n)) + " behind"
        shown = secrets.windows_of(text, 7, 7 + n)
        assert {len(w) for w in shown} == {secrets.SIZE} and len(shown) <= 1 + -(-max(0, n - secrets.INSIDE) // secrets.STEP)
        table = secrets._code_table()
        codes = bytes(int(table[ord(c)]) for c in text[7 : 7 + n])
        places = [codes.find(w[secrets.BEFORE : secrets.BEFORE + min(n, secrets.INSIDE)]) for w in shown]
        assert places[0] == 0 and all(b - a <= secrets.STEP for a, b in zip(places, places[1:]))
        assert places[-1] == max(0, n - secrets.INSIDE)
    assert secrets.window("a" * 20 + " one", 0, 20) != secrets.window("a" * 20 + " two", 0, 20)


def test_findings_may_have_any_name(spark):
    frame = spark.createDataFrame([(1, "a token=abcdefgh b")], "doc_id long, text string")
    for name in ("found", "Found", "_found"):
        rows = secrets.scanned(frame, None, into=name)
        assert rows.columns == ["doc_id", "text", name]
        assert [(s.kind, s.start, s.end) for s in rows.collect()[0][name]] == [("assign", 2, 16)]


def test_all_findings_are_learned_from(spark):
    """Findings that are dealt over shards give a network that knows every kind of them."""
    codes, labels = findings(900)
    frame = spark.createDataFrame([(c.tobytes(), int(y)) for c, y in zip(codes, labels)], "codes binary, label int").distinct()
    model = secrets.train_dealt(frame, 3)
    codes, labels = findings(200, seed=5)
    held = model.scores([c.tobytes() for c in codes]) >= model.threshold
    assert held[labels == 1].mean() >= 0.97 and held[labels == 0].mean() <= 0.02
    again = secrets.train_dealt(frame.repartition(5), 3)
    assert again.threshold == model.threshold and (again.filters == model.filters).all()
    assert secrets.train_dealt(frame.where("label = 1"), 3) is None


def test_no_finding_is_left_out_of_the_fit(spark, monkeypatch):
    texts = [f"{cases.prose(i, 3)} token={i:012x}f{i}a and x{i}.host{i}.example.com" for i in range(40)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    seen = []
    monkeypatch.setattr(secrets, "train", lambda codes, labels: seen.append(sorted(labels)))
    monkeypatch.setattr(secrets, "train_dealt", lambda found, shards: seen.append((found.count(), shards)))
    secrets.fit(docs)
    secrets.fit(docs, shard=len(seen[0]) // 4)
    assert seen[0].count(1) >= 40 and seen[1] == (len(seen[0]), 4 + (len(seen[0]) % 4 > 0))
