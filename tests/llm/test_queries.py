"""The contract queries over whole small tables: oracle SQL where there is some, otherwise brute force."""

import hashlib
import random
import re
import zlib
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cadastra.llm import near_dedup, queries

DATA = "/root/testdata/sf0.001"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(name):
    t = pq.read_table(f"{DATA}/{name}.parquet").to_pydict()
    return [dict(zip(t, r)) for r in zip(*t.values())]


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    rows = lambda f: sorted(map(repr, ([str(v) for v in r] for r in f[sorted(f.columns)].astype(object).values.tolist())))
    assert rows(queries.queries()[name](spark, DATA).toPandas()) == rows(con.execute(queries.oracle_sql()[name]).df())


def secrets_of(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_op1(spark):
    got = {r.doc_id: r for r in queries.op1_secret_scan(spark, DATA).collect()}
    docs, kinds = table("documents"), ("assign", "access", "hex")
    assert len(got) == len(docs)
    for d in docs:
        found = secrets_of(d["text"] or "")
        r = got[d["doc_id"]]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == j for _, k, _ in found) for j in range(3)]
        listed = [f"{kinds[k]}:{a}:{b}" for a, k, b in found]
        assert r.base_sha256 == sha(",".join(listed)) and set(listed) <= set(r.spans.split(","))


def test_op6(spark):
    import base64

    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in queries.op6_byte_bpe(spark, DATA).collect()}
    for d in table("documents"):
        ids = known.encode_ordinary(d["text"] or "")
        r = got[d["doc_id"]]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(d["text"] or ""))


def test_op8(spark):
    """Valid values, found by plain expressions and checked one by one, are replaced by others of their format; the rest stays."""
    luhn = lambda v: sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(int(c) for c in reversed(v) if c.isdigit())) % 10 == 0
    forms = (
        r"(?P<mail>[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})|(?P<card>\b(?:\d{4}[ -]?){3}\d{1,7}\b)|(?P<host>\b(?:\d{1,3}\.){3}\d{1,3}\b)"
        r"|(?P<phone>(?<![\d\w])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4}\b)"
    )
    got = {r.doc_id: r for r in queries.op8_pii_pseudonyms(spark, DATA).collect()}
    linked = {}
    for d in table("documents"):
        text, r = d["text"] or "", got[d["doc_id"]]
        valid = [m for m in re.finditer(forms, text, re.A) if {"card": lambda v: luhn(v), "host": lambda v: all(int(x) < 256 for x in v.split("."))}.get(m.lastgroup, lambda v: True)(m[0])]
        assert r.n_values == len(valid)
        pieces, at = [], 0
        for m in valid:
            pieces.append(re.escape(text[at : m.start()]))
            pieces.append("(u[0-9a-f]{15}@example\\.com)" if m.lastgroup == "mail" else r"((?:\d{1,3}\.){3}\d{1,3})" if m.lastgroup == "host" else "(" + re.sub(r"\d", r"\\d", re.escape(m[0])) + ")")
            at = m.end()
        new = re.fullmatch("".join(pieces) + re.escape(text[at:]), r.text or "")
        for m, n in zip(valid, new.groups()):
            assert linked.setdefault(m[0], n) == n and (m.lastgroup != "card" or luhn(n))
    assert len(set(linked.values())) == len(set(v.lower() for v in linked))


def test_op9_learns_from_its_folds_only(spark, tmp_path):
    labels = table("labels")
    for name, flip in (("a", False), ("b", True)):
        (tmp_path / name).mkdir()
        held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
        rows = [(x["doc_id"], 1 - x["quality"] if flip and held(x["doc_id"]) and x["quality"] is not None else x["quality"]) for x in labels]
        spark.createDataFrame(rows, "doc_id bigint, quality int").write.parquet(str(tmp_path / name / "labels.parquet"))
        (tmp_path / name / "documents.parquet").symlink_to(f"{DATA}/documents.parquet")
    one, other = ({r.doc_id: (r.held_out, r.score, r.predicted) for r in queries.op9_quality_classifier(spark, str(tmp_path / x)).collect()} for x in "ab")
    assert one == other and all(h == (zlib.crc32(str(k).encode()) % 5 == 0) and 0 <= s <= 1 and p == (s >= 0.3) for k, (h, s, p) in one.items())


def test_op10(spark):
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    got = {r.doc_id: r for r in queries.op10_license_scan(spark, DATA).collect()}
    for d in table("documents"):
        ws, r = re.findall(WORD, lower(d["text"])), got[d["doc_id"]]
        places = [(i, label) for p, label in phrases.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
        at, labels = [i for i, _ in places], sorted({x for _, x in places})
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (len(ws), len(places), min(at, default=None), max(at, default=None), ",".join(labels))
        assert set(labels) <= set(r.labels.split(",")) and r.labels == ",".join(sorted(r.labels.split(","))) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def components(texts):
    """(set size, smallest index reachable) of each text, by all pairs."""
    sets = []
    for t in texts:
        ws = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(t)) if w]
        sets.append({tuple(ws[k : k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    top = list(range(len(sets)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and find(a) != find(b):
                top[max(find(a), find(b))] = min(find(a), find(b))
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """Groups of edited copies around the threshold, chains, and a passage that many texts share; pairs stay few."""
    tried, verify = [], near_dedup.verify
    monkeypatch.setattr(near_dedup, "verify", lambda pairs, *more: tried.append(pairs.count()) or verify(pairs, *more))
    dealt = random.Random(7)
    vocabulary = [f"w{k}" for k in range(3000)]
    made = lambda n: dealt.choices(vocabulary, k=n)
    edited = lambda ws, n: [dealt.choice(vocabulary) if k in at else w for at in [set(dealt.sample(range(len(ws)), n))] for k, w in enumerate(ws)]
    base, passage, link = made(200), made(60), made(120)
    texts = [edited(base, dealt.choice([1, 3, 5, 6, 7, 8, 12])) for _ in range(160)]
    texts += [passage + made(dealt.choice([8, 15, 25, 60])) for _ in range(140)]
    for _ in range(40):
        link = link[4:] + made(4)
        texts.append(link)
    texts += [made(n) for n in (0, 1, 3, 4, 5, 6, 300) for _ in range(4)] + texts[:20]
    dealt.shuffle(texts)
    texts = [" ".join(t) for t in texts] + [None, "", " \n"]
    rows = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert [got[k] for k in range(len(texts))] == components(texts)
    assert sum(r.is_first for r in rows) == len({c for _, c in got.values()})
    assert sum(tried) < 8 * len(texts)


def test_pipeline_stages(spark):
    """Every stage of the pipeline against brute force on its own input, then run() against the stages."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    judged = {r.doc_id: r.kept for r in queries.op3_quality_rules(spark, DATA).collect()}
    inputs, outputs = docs, []
    for name, stage in p.STAGES:
        out = stage(spark, inputs, DATA).persist()
        before, after = ([r.asDict() for r in x.orderBy("doc_id").collect()] for x in (inputs, out))
        inputs = out
        outputs.append(after)
        if name == "quality rules":
            assert after == [r for r in before if judged[r["doc_id"]]]
        elif name == "near-dedup":
            assert after == [r for k, (r, (_, c)) in enumerate(zip(before, components([r["text"] for r in before]))) if c == k]
        elif name == "decontamination":
            wins = set()
            for x in table("benchmark"):
                ws = re.findall(WORD, lower(x["text"]))
                wins |= {tuple(ws[k : k + 10]) for k in range(max(1, len(ws) - 9))} if ws else set()
            sizes = {len(w) for w in wins}
            dirty = lambda ws: any(tuple(ws[k : k + n]) in wins for n in sizes for k in range(len(ws) - n + 1))
            assert after == [r for r in before if not dirty(re.findall(WORD, lower(r["text"])))]
        elif name == "secret scan":
            assert len(after) == len(before)
            for a, b in zip(after, before):
                assert not secrets_of(a["text"]) and (secrets_of(b["text"]) or a == b) and a["n_chars"] == len(a["text"])
        else:
            assert [{k: v for k, v in r.items() if k not in ("ids", "n_tokens")} for r in after] == before and all(r["n_tokens"] == len(r["ids"]) for r in after)
    assert sorted(map(repr, (r.asDict() for r in p.run(spark, DATA).collect()))) == sorted(map(repr, outputs[-1]))


def test_pipeline_stages_take_odd_rows(spark):
    import corpus_pipeline as p

    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "the word of it " * 5000, "en", "s", None)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for _, stage in p.STAGES:
        assert stage(spark, spark.createDataFrame([], schema), DATA).count() == 0
        stage(spark, spark.createDataFrame(rows, schema).withColumn("Kept", F.lit(1)).withColumn("ITEMS", F.lit("x")), DATA).collect()
