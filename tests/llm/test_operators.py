"""The text operators against plain versions and SQL, on edge cases and on the smallest tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pytest

pytest.importorskip("riskloom.llm")

import corpus_pipeline  # noqa: E402
from riskloom.llm import chat, decontaminate, html_extract, near_dedup, packing, pii, quality_lines, queries, substring_dedup, token_rollup, tokens, warc  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy long, host string, node string"


def fold(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def white(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def edge_texts():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base = words(140)
    out = [None, "", " \t\n", "a", "a", "A b", "a b", "é\x00 x\x1cy", " ".join(base), " ".join(base), " ".join(base).upper()]
    for _ in range(60):
        near = list(base)
        for _ in range(rng.choice([1, 2, 4, 6])):
            near[rng.randrange(140)] = rng.choice(vocabulary)
        out.append(" ".join(near))
    passage = words(50)
    out += ["\n".join([" ".join(words(40)), " ".join(passage), "Footer line 12", " ".join(words(30))]) for _ in range(14)]
    out += [" ".join(words(30) * 3), " ".join(words(9000)), "x" * 30_000, "mail a.b@c.org, +1 (555) 010-9999 4111 1111 1111 1111 10.0.0.256 9.9.9.9"]
    return out


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(k, t, "en", f"src{k % 2}" if k % 5 else None, len(t or ""), 1, "h", "n") for k, t in enumerate(edge_texts())]
    rows += [rows[8], (None, None, None, None, None, None, None, None)]  # a repeated row, and nothing but nulls
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    answer = duck.execute(queries.ORACLE[name])
    columns = [c[0] for c in answer.description]
    want = sorted((tuple(r[columns.index(c)] for c in df.columns) for r in answer.fetchall()), key=repr)
    assert sorted(columns) == sorted(df.columns)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want


def test_shingle_components(edge, empty):
    rows = edge.select("doc_id", "text").collect()
    sets = {}
    for r in rows:
        w = white(fold(r.text))
        sets[r.doc_id] = {tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations([k for k in sets if k is not None and sets[k]], 2):
        common = len(sets[a] & sets[b])
        if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    want = Counter((k, len(sets[k]), find(k), k is None or find(k) == k) for k in (r.doc_id for r in rows))
    found = near_dedup.near_duplicates(edge, 3, 85).drop("copy").collect()
    assert Counter(tuple(r) for r in found) == want
    assert near_dedup.near_duplicates(empty).count() == 0
    left = near_dedup.drop_near_duplicates(edge, 3, 85)
    assert left.columns == edge.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == sorted({k for k in sets if k is not None and find(k) == k})


def test_signature_estimates_similarity():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 900).astype(np.uint64)
    a, b = np.sort(x[:700]), np.sort(x[200:])
    ranks = near_dedup.signatures(np.concatenate([a, b]), np.array([0, 700, 1400]))
    assert abs((ranks[0] == ranks[1]).mean() - 500 / 900) < 0.15
    assert near_dedup.band_rows(85) == 5


def test_repeated_windows(edge, empty):
    rows = edge.select("doc_id", "text").collect()
    count = Counter(tuple(w[i : i + 35]) for w in (white(r.text) for r in rows) for i in range(len(w) - 34))
    want = Counter()
    for r in rows:
        w = white(r.text)
        gone = {i + j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(35)}
        want[r.doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    found = substring_dedup.remove_repeats(edge).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == want
    assert all(r.n_removed == sum(s.end - s.start for s in r.removed) for r in found)
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_pieces_hold_every_id_once(edge, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    tokenizer.encode_special_tokens = True
    ids = {r.doc_id: [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2] for r in edge.collect()}
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in packing.pack(edge).collect():
        pieces[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(part.tobytes())
    rows = Counter(r.doc_id for r in edge.collect())
    for k, found in pieces.items():
        places = Counter(i for r in found for i in range(r.start, r.start + r.length))
        assert places == Counter({i: rows[k] for i in range(len(ids[k]))})
    for found in windows.values():
        ends = 0
        for r in sorted(found, key=lambda r: r.offset):
            assert r.offset == ends
            ends += r.length
        assert ends <= packing.CAPACITY
    assert set(pieces) == set(ids) and packing.pack(empty).count() == 0


def test_special_strings_get_their_own_ids(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokens.tokenizer_path())
    special = ["<|endoftext|>", "<|startoftext|>"]
    texts = ["hello <|endoftext|> world a<|startoftext|>b", "".join(special), " ".join(special * 3), "<|endoftext|>é<|EndOfText|> <|endof text|>", "a\n<|endoftext|>\tb <|startoftext|", "x" * 50 + special[0]]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert {49406, 49407} <= set(want[0])
    data = "".join(texts).encode()
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, first = tokens.word_memo(tokens.tokenizer_path()).encode(np.frombuffer(data, np.uint8), offsets)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:])] == want
    docs = spark.createDataFrame([(k, t, "en", "s") for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    assert {r.doc_id: r.doc_tokens for r in packing.pack(docs).collect()} == {k: len(x) + 1 for k, x in enumerate(want)}
    assert {r.doc_id: r.tokens for r in token_rollup.token_counts(docs).collect() if r.tokenizer == "word_bpe_49k"} == {k: len(x) for k, x in enumerate(want)}


def test_differencing_is_near_equal():
    rng = random.Random(1)
    sizes = [rng.randrange(1, 500) for _ in range(400)]
    groups = packing.differencing(sizes, 25)
    assert sorted(i for g in groups for i in g) == list(range(400))
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 10
    assert [len(g) for g in packing.pack_block([9, 9, 9], 10)] == [1, 1, 1]


def test_rollup_batches(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame(list(x), "doc_id long, source string, lang string, tokenizer string, docs long, tokens long")
    store = token_rollup.RollupStore(spark, str(tmp_path / "store"))
    assert store.totals().count() == 0
    assert store.apply(0, rows((1, "a", "en", "t", 1, 10), (2, "a", "en", "t", 1, 5), (3, None, None, "t", 1, 7), (None, "a", "en", "t", 1, 1)))
    with pytest.raises(ValueError):
        store.apply(2)
    assert store.apply(1, rows((2, "b", "en", "t", 1, 6)), rows((1, "", "", "", 0, 0), (9, "", "", "", 0, 0)))
    assert not store.apply(1, rows((2, "b", "en", "t", 1, 600)))  # committed before
    assert store.apply(2)
    assert sorted(map(tuple, store.totals().collect()), key=repr) == sorted([("a", "en", "t", 1, 1), ("b", "en", "t", 1, 6), (None, None, "t", 1, 7)], key=repr)


def test_rollup_of_many_batches(spark, tmp_path):
    """Batches that add, revise, move and delete, against a plain table; runs, buckets, recovery."""
    rng, plain, folder = random.Random(5), {}, str(tmp_path / "long")
    schema = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long"
    runs = {}
    for batch in range(11):
        store = token_rollup.RollupStore(spark, folder, buckets=8 if batch == 0 else 99, fanout=3)
        ids = range(60) if batch == 0 else rng.sample(range(70), 3)
        gone = rng.sample(range(80), batch % 3)
        rows = [(i, f"s{rng.randrange(3)}", "en", "t", 1, rng.randrange(9)) for i in ids if i not in gone]
        assert store.apply(batch, spark.createDataFrame(rows, schema), spark.createDataFrame([(i,) for i in [*gone, None]], "doc_id long"))
        plain = {k: v for k, v in plain.items() if k not in gone} | {r[0]: r for r in rows}
        runs[batch + 1] = store._runs(store.ledger, 0, batch + 1)
    assert store.buckets == 8  # that of the first batch
    assert runs[2] == ["0-1", "1-2"] and runs[3] == ["0-3"] and runs[8] == ["0-3", "3-6", "6-7", "7-8"] and runs[11] == ["0-9", "9-10", "10-11"]
    want = Counter()
    for r in plain.values():
        want[r[1], "docs"] += 1
        want[r[1], "tokens"] += r[5]
    found = lambda: Counter({(r.source, k): n for r in store.totals().collect() for k, n in (("docs", r.n_docs), ("tokens", r.n_tokens))})
    assert found() == want
    # a batch reads the buckets of its ids only
    scans = store._before(10)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in scans
    # a run that broke off is replaced by its parts, and made when its last batch is sent again
    for table in (store.ledger, "rollup"):
        (tmp_path / "long" / table / "run=0-9" / "_SUCCESS").unlink()
    assert store._runs("rollup", 0, 11)[:3] == ["0-3", "3-6", "6-9"] and found() == want
    assert not store.apply(8) and store._runs("rollup", 0, 11)[0] == "0-9" and found() == want
    # a batch that broke off before its rollup doesn't count
    store.apply(11, deletes=spark.createDataFrame([(i,) for i in plain], "doc_id long"))
    assert store.totals().count() == 0
    (tmp_path / "long" / "rollup" / "run=11-12" / "_SUCCESS").unlink()
    (tmp_path / "long" / "rollup" / "run=9-12" / "_SUCCESS").unlink(missing_ok=True)
    assert found() == want


def test_rollup_query_is_the_totals_of_the_final_documents(spark):
    read = lambda name: spark.read.parquet(f"{SF}/{name}.parquet").collect()
    toxic = {r.doc_id for r in read("labels") if r.toxic == 1}
    poor = {r.doc_id for r in read("labels") if r.quality == 0} - toxic
    assert toxic and poor
    memo = tokens.word_memo(tokens.tokenizer_path())
    want = {}
    for r in read("documents"):
        if r.doc_id in toxic:
            continue
        text = r.text or ""
        if r.doc_id in poor:
            text = "\n".join(dict.fromkeys(text.split("\n")))
        for name, n in (("word_bpe_49k", len(memo.tokenizer.encode(text, add_special_tokens=False).ids)), ("white-space-1", len(white(text)))):
            docs, total = want.get((r.source, r.lang, name), (0, 0))
            want[r.source, r.lang, name] = (docs + 1, total + n)
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op4_token_rollup(spark, SF).collect()}
    assert got == want


def test_token_counts(edge):
    found = {(r.doc_id, r.tokenizer): r.tokens for r in token_rollup.token_counts(edge).collect()}
    assert all(found[r.doc_id, "white-space-1"] == len(white(r.text)) for r in edge.collect())


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(x) for x in reversed(re.sub(r"[^0-9]", "", m[0]))]
        if 13 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]


def test_base_patterns_are_those_of_the_contract():
    rng = random.Random(2)
    for _ in range(20_000):
        text = "".join(rng.choice("ab@.1 2-+3(é4") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)


def test_disclosing_terms(spark, edge, empty):
    texts = [f"Call Zorblax Quimby at zq@acme.org about the plan {k}" for k in range(5)] + [f"the plan about call at day {k}" for k in range(60)]
    docs = spark.createDataFrame(list(enumerate([*texts, "Quimby was here", None])), "doc_id long, text string")
    spans = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in pii.personal_spans(docs).collect() if r.doc_id < 65}
    assert spans[0] == [("email", "zq@acme.org"), ("term", "Zorblax")] or ("term", "Zorblax") in spans[0]
    assert all(not x for k, x in spans.items() if k > 4)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert "[EMAIL]" in clean[0] and "Zorblax" not in clean[0] and clean[7] == texts[7] and clean[66] is None
    out = pii.sanitise(edge)
    assert out.columns == edge.columns and out.count() == edge.count() and pii.sanitise(empty).count() == 0


def test_terms_of_an_entity_in_one_text(spark):
    filler = " ".join(f"plain word number{k % 9} here" for k in range(30))
    texts = [f"Profile of Zorblax\n{filler}\ncall +1 555 010 9999 or mail z@acme.org now", *[f"{filler} profile call mail now {k}" for k in range(199)]]
    texts += ["Zelda writes from q@acme.org and 10.0.0.1"] * 2 + [f"{filler} {k} or and from writes of" for k in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: {texts[r.doc_id][s.start : s.end] for s in r.spans if s.kind == "term"} for r in pii.personal_spans(docs).collect()}
    assert spans[0] == {"Zorblax"} and spans[200] == spans[201] == {"Zelda"}
    assert not any(x for k, x in spans.items() if k not in (0, 200, 201))
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[0] == texts[0].replace("Zorblax", "[WORD]").replace("+1 555 010 9999", "[PHONE]").replace("z@acme.org", "[EMAIL]")


def test_entity_term_counts(spark):
    texts = ["alpha beta a@x.org b@x.org", "alpha beta a@x.org b@x.org", "beta gamma a@x.org b@x.org c@x.org", "gamma d@x.org", "beta", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("copy", pii.F.xxhash64("text"))
    found = pii._beside(docs.mapInArrow(pii._find, pii._FOUND)).collect()
    assert sorted((r.n_e, r.n_te) for r in found) == sorted([(3, 2), (3, 3), (3, 1), (1, 1), (1, 1), (1, 1)])
    assert len({r.entity for r in found}) == 3  # a and b stand in the same texts


def test_benchmark_words(spark, edge, empty):
    texts = {r.doc_id: r.text for r in edge.collect()}
    letters = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", fold(t))
    items = [(1, " ".join(texts[8].split()[5:40])), (2, "A"), (3, None), (4, "..."), (5, " ".join(texts[80].split()[-20:])), (1, "b a")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for k, t in items:
        w = letters(t)
        for i in range(len(w) - min(13, len(w)) + 1 if w else 0):
            windows[tuple(w[i : i + 13])].add(k)
    for block in (decontaminate.BLOCK_WORDS, 10):
        found = decontaminate.benchmark_matches(edge, benchmark, block_words=block).collect()
        assert len(found) == edge.count()
        for r in found:
            w = letters(texts[r.doc_id])
            at = [(i, i + n, k) for n in {len(x) for x in windows} for i in range(len(w) - n + 1) for k in windows.get(tuple(w[i : i + n]), ())]
            assert (r.n_words, r.n_hit) == (len(w), len({p for s, e, _ in at for p in range(s, e)}))
            assert {m.item_id for m in r.matches} == {k for *_, k in at}
    assert decontaminate.benchmark_matches(edge, benchmark.where("FALSE")).where("n_hit > 0").count() == 0
    assert decontaminate.drop_contaminated(empty, benchmark).count() == 0


def test_large_benchmark_is_built_in_blocks(spark):
    """Two million words: blocks of a bounded size, no item lost, matches across all blocks found."""
    text = "concat_ws(' ', transform(sequence(0, 399), j -> concat('i', id, 'w', if(j % 3 = 0, j, -j))))"
    bench = spark.range(3_000).selectExpr("id AS item_id", f"{text} AS text", "1 AS block", "2 AS data")
    blocks = list(decontaminate._blocks(bench, decontaminate.BLOCK_WORDS, 13))
    assert len(blocks) == 5
    assert all(0 < len(b.lengths) <= decontaminate.BLOCK_WORDS for b in blocks)
    assert sorted(i for b in blocks for i in set(b.uses[:, 0].tolist())) == list(range(3_000))
    assert sum(len(b.uses) for b in blocks) == 3_000 * (400 + 266 - 12)  # "w-1" is two words
    quotes = bench.where("item_id % 1000 = 7").selectExpr("item_id AS doc_id", "concat('none of it, ', substring_index(text, ' ', 50), ' and so on') AS text")
    found = decontaminate.benchmark_matches(quotes.unionAll(quotes), bench).collect()
    assert len(found) == 6 and all((r.n_hit, r.n_words) == (83, 89) and [m.item_id for m in r.matches] == [r.doc_id] for r in found)


def test_chat_events(spark):
    log = [
        (1, 1, 0, "open", "user", None), (1, 2, 0, "delta", None, "Hel"), (1, 3, 0, "delta", None, "lo"), (1, 4, 1, "open", "assistant", None),
        (1, 5, 1, "delta", None, "draft"), (1, 6, 1, "regenerate", None, None), (1, 7, 1, "delta", None, "</s><s>[x]\n"), (1, 8, 0, "edit", None, "Hi"),
        (1, 9, 0, "delta", None, "!"), (1, 10, 2, "open", "user", None), (1, 11, 2, "delete", None, None), (2, 1, 0, "delta", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, message long, kind string, role string, text string")
    back = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold_messages(events))).collect()}
    assert [tuple(t) for t in back[1].turns] == [("user", "Hi!"), ("assistant", "</s><s>[x]\n")]
    assert back[1].learnt == ["</s><s>[x]\n"] and [tuple(t) for t in back[2].turns] == [("", "")]


def test_chat_turns(spark):
    rng = random.Random(4)
    odd = lambda n: "".join(rng.choice("\\<[]/s>n\n|é") for _ in range(n))
    rows = [(k % 7, k // 7 if k % 3 else None, rng.choice(["user", "assistant", None, "a\n[n"]), odd(k % 40) if k % 11 else None) for k in range(200)]
    rows += [rows[5], (None, 1, "user", "x" * 5000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: [tuple(t) for t in r.turns] for r in chat.read_back(chat.format_turns(turns)).collect()}
    want = defaultdict(list)
    for c, _, role, text in rows:
        want[c].append((role or "", text or ""))
    assert {c: Counter(t) for c, t in found.items()} == {c: Counter(t) for c, t in want.items()}
    assert chat.format_turns(turns.where("FALSE")).count() == 0


PAGE = """<html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar"><header><h1>Site</h1></header>
<div id="cookie-notice">We use</div><ul class="menu"><li><a href=x>Home</a><li>b</ul><div class="content post-12"><h1>Title &amp; <i>more</i></h1>
<p>Para one, with <a href="/x">link</a> text that is long enough.<p>Para two<br>next <b>bold</p><div class="ad">Buy</div><form>Mail</form>
<ul><li>i1<li>i2</ul></div><div class="sidebar">Side</div><section id="comments"><p>Reader says a very long comment, on and on.</p></section><footer>f</footer>"""


def test_articles(spark):
    rows = [(k, f"http://Host.org/{k}", PAGE) for k in range(3)] + [(9, None, None), (10, "x", ""), (11, "http://host.org", "<p>a &lt; b"), (11, "", "<div><div")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", html_extract.F.lit(1))
    found = html_extract.extract_articles(pages).collect()
    want = "Title & more\nPara one, with link text that is long enough.\nPara two next bold\ni1\ni2"
    assert sorted((r.page_id, r.text) for r in found) == [(0, want), (1, want), (2, want), (9, ""), (10, ""), (11, ""), (11, "a < b")]
    assert html_extract.extract_articles(pages.where("FALSE")).count() == 0


def test_whole_articles(spark):
    long = lambda k, n=30: " ".join(f"word{k}x{j}" for j in range(n)) + "."
    a, b, c, d = long(1, 120), long(2, 25), long(3, 15), long(4)
    links = "".join(f"<a href=/{k}>Another page {k}</a> " for k in range(20))
    menu = "<nav><a href=/>Home</a></nav>"
    bodies = {
        "title": (f"{menu}<article><h1>Title</h1><div class=content><p>{a}</p><p>{b}</p></div></article><footer>f</footer>", ["Title", a, b]),
        "sections": (f"<article><h1>T</h1><section class=lead>{b}</section><section class=long>{a}</section><section class=end>{c}</section></article>", ["T", b, a, c]),
        "main": (f"<main><h1>T</h1><article><div><div><p>{a}</div></div></article></main><div class=links>{links}</div>", ["T", a]),
        "deep": ("<article>" + "".join(f"<div><div><div><div><p>{long(k)}</p></div></div></div></div>" for k in range(9)) + f"</article><div class=x>{d}{b}</div>", [long(k) for k in range(9)]),
        "plain": (f"<div class=page><h1>T</h1><p>{c}</p><div class=story><p>{a}</p></div><div class=more><div>{d}</div></div></div><div class=links>{links}</div>", ["T", c, a, d]),
    }
    rows = [(k, f"http://{host}.org/{k}", f"<html><body>{body}</body></html>") for host, (body, _) in bodies.items() for k in range(3)]
    rows += [(9, "http://ends.org/", "<div>" * 3000 + a)]
    found = html_extract.extract_articles(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    want = [(k, f"http://{host}.org/{k}", "\n".join(x)) for host, (_, x) in bodies.items() for k in range(3)] + [(9, "http://ends.org/", a)]
    assert sorted((r.page_id, r.url, r.text) for r in found) == sorted(want)


def test_archives(spark, tmp_path):
    first = "WARC/1.1\r\n"
    texts = ["", first, f"\r\n{first}", f"a\r\n\r\n{first}\r\n{first}", "x\r\n\r\nWARC/1.1", "\r\n\r\n", "é" * 5000, "é" * 5000, f"ab\r\n\r\n{first}" * 300, "\U0001f600z" * 3000, None]
    rows = [(k if k != 4 else None, f"http://x/\r\n {k}" if k % 3 else None, t) for k, t in enumerate(texts)] + [(6, "u", "é" * 5000)]
    folder = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2), folder, chunk=1000)
    found = warc.read_records(spark, folder).collect()
    want = Counter((p, len((t or "").encode()), hashlib.sha1((t or "").encode()).hexdigest()) for p, _, t in rows)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in found) == want and all(r.intact for r in found)
    assert sorted((r.page_id, r.refers_to) for r in found if r.record_type == "revisit") == [(6, 7), (6, 7)]
    chunks = warc.read_chunks(warc.read_segments(spark, folder))
    assert chunks.where("length(chunk) > 1000").count() == 0 and chunks.where("chunk_no > 1").count() > 10
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder + "0")
    assert warc.read_records(spark, folder + "0").count() == 0


def test_quality_lines(edge, empty):
    judged = quality_lines.quality_verdicts(edge.select("doc_id", "text", "source")).collect()
    assert len(judged) == edge.count()
    for r in judged:
        w = white(r.text)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (r.text or "").split("\n") if white(x)]
        assert (r.n_words, r.word_chars, r.n_repeat_words, r.n_dup_lines) == (len(w), sum(map(len, w)), len(again), len(lines) - len(set(lines)))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
    kept = quality_lines.keep_quality(edge)
    assert kept.columns == edge.columns and quality_lines.keep_quality(empty).count() == 0
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in judged if r.kept)


def test_frequent_lines_go(spark):
    rows = [(k, "menu 1 home\n" + " ".join(f"w{k}x{j}" for j in range(60)), "s") for k in range(30)]
    rows += [(40, "\n".join(["Menu 2  home"] * 40), "s"), (41, "menu 1 home\n" + " ".join(f"y{j}" for j in range(60)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in quality_lines.keep_quality(docs).collect()}
    assert set(kept) == {*range(30), 41} and not any("menu" in kept[k] for k in range(30)) and "menu" in kept[41]


def test_a_line_in_many_texts_goes_from_a_large_host(spark):
    body = lambda k, n=70: " ".join(f"w{k}x{j}" for j in range(n))
    footer = " ".join(f"Right{j}" for j in range(60))
    rows = [(k, f"{footer}\n{body(k)}" if k < 25 else f"Seen {k % 30}\n{body(k)}", "s") for k in range(400)]
    rows += [(400, f"{body(400, 20)}\n{footer.upper()}", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r.doc_id: r.text for r in quality_lines.keep_quality(docs, many=20).collect()}
    assert kept == {k: body(k) if k < 25 else t for k, t, _ in rows if k < 400}
    assert 400 in {r.doc_id for r in quality_lines.quality_verdicts(docs).where("kept").collect()}  # the share alone, as in SQL


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = near_dedup.save_scratch(stage(spark, docs, SF), "test-stage")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= before
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before


def test_near_duplicates_hand_small_batches_to_python(spark, monkeypatch):
    """Texts are long, so a batch of Spark's usual 10,000 rows took more of an executor than it has."""
    from riskloom.llm import near_dedup

    name, seen, save = "spark.sql.execution.arrow.maxRecordsPerBatch", [], near_dedup.save_scratch
    before = spark.conf.get(name)

    def watched(df, label):
        seen.append((label, int(spark.conf.get(name))))
        return save(df, label)

    monkeypatch.setattr(near_dedup, "save_scratch", watched)
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, None)], "doc_id bigint, text string")
    found = {r.doc_id: r.kept for r in near_dedup.near_duplicates(docs).collect()}
    assert found == {1: True, 2: False, 3: True} and spark.conf.get(name) == before
    assert {"sets", "links"} <= {label for label, _ in seen} and {rows for _, rows in seen} == {near_dedup.BATCH_ROWS}
