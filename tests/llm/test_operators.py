"""The pipeline operators on small tables: brute force, exact round trips, held-out accuracy, and odd rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row, functions as F

from linecross.llm import bpe, decontaminate, html_text, jaccard, langid, lm, packing, quality, queries, substring_dedup, suffix_sort, warc
from linecross.llm.common import fold_ascii, hashed_words, shared_folder, stage

SF = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
LONG = "word salad again " * 20_000
ODD = [(1, None, "en"), (2, "", "en"), (3, " \n\t", None), (4, "one two three", "en"), (4, "one two three", "en"), (None, "one two three", None),
       (5, "ÄÖ ß Σς İ x\x1cy", "de"), (6, LONG, "en"), (7, LONG, None), (8, "a" * 70_000, "fr"), (9, "12 34 !!", None), (10, "x퟿\U0001f600 \x00 z", "es")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns that clash with the operators' own names."""
    rows = [(i, t, c, "s", 0, 1.0, "x", 3) for i, t, c in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, lang_pred string, sig bigint")


@pytest.fixture(scope="module")
def empty(odd):
    return odd.where("false")


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def ascii_words(text):
    return (text or "").encode().translate(fold_ascii).split()


# --- 1 quality -------------------------------------------------------------------------------------------


def test_base_figures(spark, odd):
    def plain(text):
        words = [w for w in (text or "").encode().split()]
        seen, lines = set(), 0
        for line in (text or "").split("\n"):
            if line.encode().split():
                lines += line in seen
                seen.add(line)
        windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
        hit = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
        return len(words), sum(len(w.decode()) for w in words), sum((text or "").count(c) for c in "#*$%&|<>"), lines, len(hit)

    docs = table(spark, "documents").select("doc_id", "text").union(odd.select("doc_id", "text"))
    got = quality.quality_scores(docs).join(docs.dropDuplicates(["doc_id"]), "doc_id").collect()
    assert len(got) > 200
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        want = plain(texts[r.doc_id])
        if want[0] != r.n_words:
            continue  # an id of both tables
        assert tuple(r[c] for c in quality.FIGURES[:5]) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_label_model_finds_accuracies_and_keeps_clean_text(spark):
    rng = np.random.default_rng(5)
    good = rng.random(20_000) < 0.85
    false_alarm, alarm = np.array([0.0, 0.003, 0.002]), np.array([0.5, 0.4, 0.6])
    votes = np.where(rng.random((20_000, 3)) < np.where(good[:, None], false_alarm, alarm), -1, 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality.LabelModel(3).fit(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.08 and (np.abs(model.rates[:, 0, 0] - alarm) < 0.15).all()
    scored = quality.quality_scores(table(spark, "documents", SMALL)).join(table(spark, "labels", SMALL), "doc_id")
    clean = scored.where("quality = 1 AND NOT base_failed")
    assert clean.where("kept").count() >= 0.99 * clean.count()
    junk = scored.where("quality = 0 AND NOT base_failed")
    assert junk.where("NOT kept").count() >= 0.8 * junk.count()


# --- 2 language ------------------------------------------------------------------------------------------


def test_language_held_out_accuracy(spark):
    got = queries.op2_language_id(spark, SMALL).join(table(spark, "documents", SMALL).select("doc_id", "lang"), "doc_id")
    held = got.where("held_out AND lang IS NOT NULL")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()
    assert got.where("score < 0 OR score > 1").isEmpty()


def test_language_odd_rows(odd, empty):
    model = langid.train_language_model(odd)
    told = langid.predict_language(odd, model)
    assert sorted(told.columns) == sorted(odd.columns) and told.count() == len(ODD)
    und = {r.doc_id for r in told.where("lang_pred = 'und'").collect()}
    assert und == {1, 2, 3, 9}
    assert langid.predict_language(odd, langid.train_language_model(empty)).where("lang_pred <> 'und' OR score <> 0").isEmpty()


# --- 3 language model ------------------------------------------------------------------------------------


@pytest.mark.parametrize("order, shard_tokens", [(2, 1 << 20), (2, 4_000), (3, 4_000), (5, 4_000)])
def test_language_model_against_direct_counts(spark, order, shard_tokens):
    """Several shards, with hot words in all places, agree with counts of a dictionary per order."""
    rows = table(spark, "documents")
    docs = rows.collect()
    got = {r.doc_id: r for r in lm.language_model_scores(rows, order=order, shard_tokens=shard_tokens).collect()}
    tokens = {d.doc_id: [*ascii_words(d.text), None] for d in docs}
    windows = {i: [tuple(([0] * (order - 1) + t)[k:k + order]) for k in range(len(t))] for i, t in tokens.items()}
    words, counts = Counter(), {order: Counter()}
    for i, t in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            words.update(t)
            counts[order].update(windows[i])
    if shard_tokens < 1 << 20:
        assert sum(n > shard_tokens // 4 for n in words.values()) > 1 and sum(words.values()) > 3 * shard_tokens
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(gram[1:] for gram in counts[k + 1])
    discounts, context = {}, {}
    for k, grams in counts.items():
        discounts[k] = lm._discounts(np.bincount(np.minimum(list(grams.values()), 5), minlength=6)[1:5])
        context[k] = defaultdict(lambda: [0, 0, 0, 0])
        for gram, n in grams.items():
            context[k][gram[:-1]][0] += n
            context[k][gram[:-1]][min(n, 3)] += 1
    total, types = sum(words.values()), len(words)

    def probability(gram):
        if not gram:
            return 1 / (types + 1)
        k, lower = len(gram), probability(gram[1:])
        if gram[:-1] not in context[k]:
            return lower
        c, *times = context[k][gram[:-1]]
        n, d = counts[k][gram], discounts[k]
        return max(n - d[min(n, 3)], 0) / c + sum(x * y for x, y in zip(d[1:], times)) / c * lower

    some = next(iter(counts[order]))[:-1]
    assert abs(sum(probability((*some, v)) for v in words) + probability((*some, b"never seen")) - 1) < 1e-9
    for i, t in tokens.items():
        assert (got[i].n_tokens, got[i].train_tokens, got[i].n_known) == (len(t), total, sum(words[v] > 0 for v in t))
        assert math.isclose(got[i].base_score, sum(math.log10((words[v] + 0.5) / (total + 0.5 * (types + 1))) for v in t), rel_tol=1e-9)
        assert math.isclose(got[i].score, sum(math.log10(probability(gram)) for gram in windows[i]), rel_tol=1e-9)


def test_language_model_query(spark):
    """The query's training rows, and two words of context that tell held-out text better than one."""
    got = {r.doc_id: r for r in queries.op3_language_model(spark, SMALL).collect()}
    rows = table(spark, "documents", SMALL)
    assert len(got) == rows.count() and all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 1) for i, r in got.items())
    pairs = {r.doc_id: r.score for r in lm.language_model_scores(rows, order=2).collect()}
    assert sum(r.score for r in got.values() if r.held_out) > sum(pairs[i] for i, r in got.items() if r.held_out)


def test_language_model_odd_rows(odd, empty):
    assert lm.language_model_scores(empty).count() == 0
    got = lm.language_model_scores(odd)
    assert got.count() == len(ODD) and got.where("doc_id = 1").first().n_tokens == 1
    untrained = lm.language_model_scores(odd.where("doc_id = 4"), "false").first()
    assert untrained.score == 0 and untrained.train_tokens == 0


# --- 4 decontamination -----------------------------------------------------------------------------------


def levenshtein_inside(item, part):
    row = [0] * (len(part) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, p in enumerate(part, 1):
            new.append(min(row[j - 1] + (w != p), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_infix_distance():
    rng = random.Random(4)
    for _ in range(200):
        item, part = [[rng.randint(0, 3) for _ in range(rng.randint(1, 9))] for _ in range(2)]
        distance, a, b = decontaminate.infix_distance(np.array(item), np.array(part))
        assert distance == levenshtein_inside(item, part)
        assert 0 <= a <= b <= len(part) and levenshtein_inside(item, part[a:b]) == distance


def test_leaks_against_every_document(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_leaks(docs, items).collect()}
    want = {}
    for d in docs.collect():
        words = decontaminate.normal_words(d.text)
        bag = Counter(words)
        for item in items.collect():
            own = decontaminate.normal_words(item.text)
            if sum((Counter(own) & bag).values()) >= len(own) - int(0.25 * len(own)):
                distance = levenshtein_inside(own, words)
                if distance <= int(0.25 * len(own)):
                    want[d.doc_id, item.item_id] = distance
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want) > 0
    exact = {k for k, v in want.items() if v == 0}
    assert exact <= set(got)


def test_recall_of_edited_passages(spark):
    rng = random.Random(8)
    items = [(r.item_id, r.text) for r in table(spark, "benchmark").collect()]
    words = [w for r in table(spark, "documents").limit(50).collect() for w in (r.text or "").split()]
    found = decontaminate.Items(items, 0.25, 4, 8, 3)
    hits = 0
    for _ in range(300):
        item, text = rng.choice(items)
        part = text.split()
        for _ in range(rng.randint(0, int(0.25 * len(part)))):
            at, how = rng.randrange(len(part)), rng.random()
            if how < 0.4:
                part[at] = rng.choice(words)
            elif how < 0.7:
                del part[at]
            else:
                part.insert(at, rng.choice(words))
        hits += any(r[1] == item for r in found.search([0], [" ".join(rng.choices(words, k=40) + part + rng.choices(words, k=40))]))
    assert hits >= 0.95 * 300


def test_decontamination_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one two three"), (3, "one two three"), (None, "x")], "item_id bigint, text string")
    assert sorted(str(r.doc_id) for r in decontaminate.find_leaks(odd, items).where("item_id = 3").dropDuplicates(["doc_id"]).collect()) == ["4", "None"]
    kept = decontaminate.drop_leaked(odd, items)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3
    assert decontaminate.find_leaks(empty, items).count() == 0 and decontaminate.find_leaks(odd, items.where("false")).count() == 0


# --- 5 pages ---------------------------------------------------------------------------------------------


def test_minimum_cut_is_least():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 8)
        gain = [rng.uniform(-3, 3) for _ in range(n)]
        ties = [(a, b, rng.uniform(0, 2)) for a in range(n) for b in range(a + 1, n) if rng.random() < 0.5]
        cost = lambda side: sum(-g if s else 0 for g, s in zip(gain, side)) + sum(c for a, b, c in ties if side[a] != side[b])
        best = min(cost([bool(mask >> i & 1) for i in range(n)]) for mask in range(1 << n))
        assert abs(cost(html_text.minimum_cut(gain, ties)) - best) < 1e-6


def test_pages(spark):
    import html
    import re
    pages = table(spark, "pages", SMALL)
    got = {r.page_id: r for r in queries.op5_html_text(spark, SMALL).collect()}
    for r in pages.collect():
        inside = re.search("<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inside))
        assert got[r.page_id].text == "\n".join(p for p in parts if p) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_page_oddities(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<p>a", "x"), (
        3, "u", "<header><h1>Site</h1></header><div class='cookie-notice'>We use cookies.</div><div id=content><h2>T &amp; U</h2><p>First <i>part</i>&nbsp;of "
        "the text, long enough to be read.<p>Second part<br>of it.<div class=comments><p>Nice one.</div></div><form><label>Mail</label></form>"
        "<script>if (a<b) x='</p>'</script> <b", "x")], "page_id bigint, url string, html string, text string")
    model = html_text.train_block_model(pages)
    got = {r.page_id: r.text for r in html_text.extract_text(pages, model).collect()}
    assert got[1] == got[2] == "" and got[3] == "T & U\nFirst part of the text, long enough to be read.\nSecond part of it."
    assert html_text.extract_text(pages.where("false"), model).count() == 0


# --- 6 substrings ----------------------------------------------------------------------------------------


def test_suffix_sort():
    rng = random.Random(1)
    for _ in range(200):
        alphabet = rng.choice([b"ab", b"abc", b"abcdefgh", bytes(range(256))])
        text = bytes(rng.choice(alphabet) for _ in range(rng.randint(1, 200)))
        if rng.random() < 0.3:
            text = text[:max(1, len(text) // 5)] * 6
        depth = rng.choice([1, 8, 9, 56, 120])
        blocks = list(suffix_sort.sorted_suffixes(np.frombuffer(text, np.uint8), depth))
        assert sorted(np.concatenate([p for p, _ in blocks]).tolist()) == list(range(len(text)))
        for places, shared in blocks:
            for a, b, s in zip(places, places[1:], shared[1:]):
                x, y = text[a:], text[b:]
                common = next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
                assert x[:depth] <= y[:depth] and min(common, depth) == min(s, depth)


def test_queue_spills():
    queue = suffix_sort.Queue(memory=10)
    for k in range(50):
        queue.push(np.array([k]), np.array([-k]))
    got = []
    while (block := queue.pop()) is not None:
        got += list(zip(block[0].tolist(), block[1].tolist()))
    assert got == [(k, -k) for k in range(50)]


def removed(rows, length=50):
    low = {}
    for i, data in rows:
        for k in range(len(data) - length + 1):
            w = data[k:k + length]
            low[w] = min(low.get(w, math.inf), math.inf if i is None else i)
    out = []
    for i, data in rows:
        mark = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if low[data[k:k + length]] < (math.inf if i is None else i):
                mark[k:k + length] = b"\1" * length
        spans = sum(m and not (k and mark[k - 1]) for k, m in enumerate(mark))
        kept = hashlib.sha256(bytes(c for c, m in zip(data, mark) if not m)).hexdigest()
        out.append((str(i), len(data), sum(mark), spans, kept))
    return sorted(out)


def test_substrings_against_brute_force(spark, odd):
    docs = table(spark, "documents").select("doc_id", "text").union(odd.select("doc_id", "text").where("doc_id <> 7"))
    got = substring_dedup.removal_digests(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == removed([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])


def test_substrings_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 40_000)
    docs = table(spark, "documents").select("doc_id", "text").repartition(7)
    got = substring_dedup.removal_digests(docs).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == removed([(r.doc_id, (r.text or "").encode()) for r in docs.collect()])


def test_substring_lookups_do_not_grow_with_the_shards(spark, monkeypatch):
    """A step of text asks a fixed number of files, however many shards there are, and finds what it did."""
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 4_000)
    docs = table(spark, "documents").select("doc_id", "text").repartition(5)
    tables, folder = substring_dedup.build_tables(docs)
    assert tables.shards > 100
    asked, real = set(), substring_dedup.mapped
    monkeypatch.setattr(substring_dedup, "mapped", lambda name, kind: asked.add(name) or real(name, kind))
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    spans = substring_dedup.covered(tables, np.array([i for i, _ in rows]), [d for _, d in rows], 50)
    got = [(str(i), len(d), sum(b - a for a, b in s), len(s), hashlib.sha256(substring_dedup._rest(d, s)).hexdigest()) for (i, d), s in zip(rows, spans)]
    assert sorted(got) == removed(rows)
    assert len({name.rsplit("/", 1)[1].split(".")[0] for name in asked}) <= 3 * 16
    substring_dedup.delete_path(spark, folder)


@pytest.mark.parametrize("length", [20, 100, 200, 400])
def test_substrings_of_any_length(spark, odd, length):
    docs = table(spark, "documents").select("doc_id", "text").union(odd.select("doc_id", "text").where("doc_id <> 7"))
    got = substring_dedup.removal_digests(docs, length).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == removed([(r.doc_id, (r.text or "").encode()) for r in docs.collect()], length)


def test_substrings_odd_rows(odd, empty):
    kept = substring_dedup.without_repeats(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD)
    assert kept.where("doc_id = 7").first().text == "" and kept.where("doc_id = 1").first().text is None
    assert substring_dedup.removal_digests(empty).count() == 0


def test_stretches_alone_with_their_anchor_are_not_sorted(monkeypatch, tmp_path):
    """A copied passage is the same stretches in both texts; only those at its ends meet others of their anchor."""
    rng = random.Random(7)
    passage = bytes(rng.choice(b"abcdefghijklmnop ") for _ in range(20_000))
    rows = [(1, b"first" + passage), (2, passage[:9_000] + b"ZZ" + passage[9_000:] + b"end"), (3, passage[:100] * 3), (4, b""), (5, passage[5_000:7_000])]
    docs = pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows]), pa.array([d.decode() for _, d in rows])], ["doc_id", "text"])

    class Local:
        def mapInArrow(self, run, schema):
            return list(run(iter([docs])))

    class Listed(list):
        def collect(self):
            return self

    def per_shard(blocks, shards, finish, schema):
        groups = defaultdict(list)
        for block in blocks:
            for r in block.to_pylist():
                groups[r["shard"]].append((r["a"], r["b"]))
        return Listed(Row(**r) for shard, parts in groups.items() for r in finish(shard, parts).to_pylist())
    monkeypatch.setattr(substring_dedup, "per_shard", per_shard)
    monkeypatch.setattr(substring_dedup, "stage", lambda rows, label: rows)
    monkeypatch.setattr(substring_dedup, "discard", lambda rows: None)
    sizes, real = [], substring_dedup.sorted_suffixes
    monkeypatch.setattr(substring_dedup, "sorted_suffixes", lambda text, depth: sizes.append(len(text)) or real(text, depth))
    tables = substring_dedup.Tables(3)
    substring_dedup._find_suspects(Local(), tables, f"file://{tmp_path}", 50)
    substring_dedup._sort_suspects(Local(), tables, f"file://{tmp_path}", 50)
    assert sum(sizes) < len(passage) // 10
    parts = [d for _, d in rows]
    spans = substring_dedup.covered(tables, np.array([i for i, _ in rows]), parts, 50)
    got = [(str(i), len(d), sum(b - a for a, b in s), len(s), hashlib.sha256(substring_dedup._rest(d, s)).hexdigest()) for (i, d), s in zip(rows, spans)]
    assert sorted(got) == removed(rows)


def test_stretches_by_blocks(monkeypatch):
    """Stretches are every window of every text once, with the anchor of its smallest hash, whatever the blocks hashed at once."""
    rng = random.Random(2)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.choice([0, 1, 49, 50, 51, 300]))) for _ in range(60)] + [b"a" * 500, b""]
    whole = substring_dedup.stretches(parts, 50)
    monkeypatch.setattr(substring_dedup, "_BLOCK", 7)
    assert all((a == b).all() for a, b in zip(whole, substring_dedup.stretches(parts, 50)))
    _, begin, owner, start, count, anchor = whole
    windows = [(o, w) for o, s, n in zip(owner.tolist(), start.tolist(), count.tolist()) for w in range(s, s + n)]
    assert windows == [(o, b + k) for o, (b, p) in enumerate(zip(begin.tolist(), parts)) for k in range(len(p) - 49)]
    assert count.max() <= substring_dedup.STRETCH
    data, by_window = b"".join(parts), {}
    for s, n, a in zip(start.tolist(), count.tolist(), anchor.tolist()):
        assert all(by_window.setdefault(data[w:w + 50], a) == a for w in range(s, s + n))


# --- 7 archives ------------------------------------------------------------------------------------------


def archive(tmp_path, count=5, zipped=True):
    out, starts = b"", []
    for i in range(count):
        page = (f"<p>page {i}</p>" * 300).encode()
        text = warc.record(i, "http://a/é", page, hashlib.sha1(page).hexdigest(), None, False, "2020-01-01T00:00:00Z")
        packer = zlib.compressobj(3, zlib.DEFLATED, 31)
        starts.append(len(out))
        out += packer.compress(text) + packer.flush() if zipped else text
    return out, [*starts, len(out)]


@pytest.mark.parametrize("zipped", [True, False])
def test_salvage(tmp_path, zipped):
    data, starts = archive(tmp_path, zipped=zipped)
    path = tmp_path / "a.warc"
    path.write_bytes(data)
    whole = list(warc.salvage(str(path)))
    assert [r["page_id"] for r in whole] == [0, 1, 2, 3, 4] and whole[0]["url"] == "http://a/é"
    broken = bytearray(data)
    broken[starts[1] + 40:starts[1] + 60] = b"\0" * 20
    broken = bytes(broken[:starts[2]]) + b"garbage between" + bytes(broken[starts[2]:starts[5] - 30])
    path.write_bytes(broken)
    rows = list(warc.salvage(str(path)))
    assert [r["page_id"] for r in rows if r["kind"] == "record"] == [0, 2, 3]
    gaps = [(r["at"], r["gap_bytes"]) for r in rows if r["kind"] == "gap"]
    assert sum(n for _, n in gaps) == len(broken) - sum(starts[k + 1] - starts[k] for k in (0, 2, 3)) and gaps[0][0] == starts[1]


def test_archives_round_trip(spark):
    big = "<p>copy</p>" * 200
    pages = spark.createDataFrame([(1, "u", big, 1), (5, "v", big, 1), (5, "v", big, 1), (2, None, None, 1), (None, "w\r\nx", big, 1), (3, "u", "small", 1),
                                   (4, "u", "small", 1), (6, "u", "", 1)], "page_id bigint, url string, html string, digest int")
    records, gaps = warc.warc_round_trip(spark, pages)
    got = sorted((str(r.page_id), r.url, r.payload_bytes, r.record_type, r.refers_to) for r in records.collect())
    assert got == sorted([("1", "u", 2200, "revisit", 5), ("5", "v", 2200, "response", None), ("5", "v", 2200, "response", None),
                          ("2", None, 0, "response", None), ("None", "w\r\nx", 2200, "revisit", 5), ("3", "u", 5, "response", None),
                          ("4", "u", 5, "response", None), ("6", "u", 0, "response", None)], key=lambda r: (r[0], r[1]))
    assert gaps.isEmpty()
    assert warc.warc_round_trip(spark, pages.where("false"))[0].isEmpty()


# --- 8 and 9 tokens --------------------------------------------------------------------------------------


def test_bpe_equals_library(spark):
    from tokenizers import Tokenizer
    path = queries.vocabulary_path()
    own, library = bpe.load(path), Tokenizer.from_file(path)
    texts = [r.text for r in table(spark, "documents").limit(150).collect()] + [t for _, t, _ in ODD] + [
        "<|endoftext|> hi<|startoftext|>", "don't we'LL '' 'S", "é ﬁ Å ǅ ẞ", "½²٣ 12", "ab" * 90 + " 日本語テキスト" * 30, "<|x|>"]
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_memory_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 3)
    own = bpe.Bpe(queries.vocabulary_path())
    once = own.encode(["some words to split", "other words entirely here"])
    assert once == own.encode(["some words to split", "other words entirely here"])


def test_bpe_columns(odd, empty):
    got = bpe.bpe_encode(odd, queries.vocabulary_path(), ids="score", decoded="lang_pred")
    assert got.count() == len(ODD) and set(got.columns) == set(odd.columns)
    assert bpe.bpe_encode(empty, queries.vocabulary_path()).count() == 0


def test_bpe_holds_a_megabyte_of_words(spark, monkeypatch):
    """A batch of a task is encoded in slices, not whole, and all of its rows come out in order."""
    batch = pa.record_batch({"doc_id": pa.array(range(4000)), "text": pa.array(None if n % 9 == 0 else f"word{n % 7} " * 200 for n in range(4000))})
    docs, caught = spark.createDataFrame([(1, "a")], "doc_id long, text string"), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: caught.append(run) or self)
    bpe.bpe_encode(docs, queries.vocabulary_path(), decoded="back")
    held, real = [], bpe.Bpe.encode
    monkeypatch.setattr(bpe.Bpe, "encode", lambda self, texts: held.append(sum(len(t or "") for t in texts)) or real(self, texts))
    got = pa.Table.from_batches(list(caught[0](iter([batch]))))
    assert max(held) <= 1 << 20 and got.column("doc_id").to_pylist() == list(range(4000))
    coded = real(bpe.load(queries.vocabulary_path()), batch.column("text").to_pylist())
    assert got.column("ids").to_pylist() == [np.frombuffer(x, "<u4").tolist() for x in coded]
    assert got.column("back")[0].as_py() == "" and got.column("back")[1].as_py().startswith("word</w> 1</w> word</w>")


def test_best_fit_decreasing():
    rng = random.Random(6)
    for _ in range(50):
        width = rng.randint(1, 40)
        lengths = [rng.randint(1, width) for _ in range(rng.randint(0, 60))]
        placed, rows = packing.best_fit_decreasing(lengths, width)
        room = []  # the same by looking at every row
        for n in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
            fit = [r for r in room if r >= lengths[n]]
            if fit:
                room[room.index(min(fit))] -= lengths[n]
            else:
                room.append(width - lengths[n])
        taken = [[False] * width for _ in range(rows)]
        for (row, start), n in zip(placed, lengths):
            assert not any(taken[row][start:start + n]) and start + n <= width
            taken[row][start:start + n] = [True] * n
        assert rows == len(room) and sorted(width - sum(t) for t in taken) == sorted(room)


def test_packing_round_trip(spark, odd):
    import public_tokenizers
    path = queries.vocabulary_path("byte_bpe_50k.tiktoken")
    docs = odd.where("doc_id IS NULL OR doc_id <> 4").union(odd.where("doc_id = 4").limit(1))
    segments = stage(packing.pack_documents(docs, shared_folder(spark, "packed"), path, public_tokenizers.PATTERN, 64, 50256, 3000), "segments").toPandas()
    encoder, back = packing.byte_encoder(path, public_tokenizers.PATTERN), {}
    for name, part in segments.groupby("shard"):
        matrix, cuts, resets = packing.read_shard(name, 64)
        assert sorted(resets.tolist()) == sorted((part.row * 64 + part.start).tolist())
        for row, own in part.groupby("row"):
            assert sorted(own.start + own.n_ids) == cuts[row][1:].tolist() and cuts[row][0] == 0
        for s in part.itertuples():
            back.setdefault(str(s.doc_id).removesuffix(".0"), {})[s.segment] = matrix[s.row, s.start:s.start + s.n_ids].tolist()
    texts = {str(r.doc_id): r.text for r in docs.collect()}
    for key, parts in back.items():
        ids = [i for k in sorted(parts) for i in parts[k]]
        assert ids == [*encoder.encode_ordinary(texts["None" if key == "nan" else key] or ""), 50256]
    assert len(back) == len(texts)


# --- 10 similar documents --------------------------------------------------------------------------------


def components(rows):
    sets = []
    for i, text in rows:
        w = ascii_words(text)
        sets.append((i, frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            common = len(x & y)
            if common and 100 * common >= 75 * (len(x) + len(y) - common):
                parent[root(a)] = root(b)
    low = {}
    for n, (i, _) in enumerate(sets):
        low[root(n)] = min(low.get(root(n), math.inf), math.inf if i is None else i)
    return sorted((str(i), len(s), None if low[root(n)] == math.inf else low[root(n)]) for n, (i, s) in enumerate(sets))


def test_similar_documents_against_all_pairs(spark, odd):
    rng = random.Random(9)
    words = [f"w{k}" for k in range(400)]
    rows = [(r.doc_id, r.text) for r in table(spark, "documents").collect()] + [(i, t) for i, t, _ in ODD]
    key = 10_000
    for family in range(6):
        base = rng.choices(words, k=rng.choice([6, 30, 120]))
        for _ in range(40):  # near copies around the threshold
            part = list(base)
            for _ in range(rng.randint(0, max(1, len(part) // 20))):
                part[rng.randrange(len(part))] = rng.choice(words)
            rows.append((key := key + 1, " ".join(part)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = jaccard.similar_documents(docs).collect()
    want = [(i, n, None if i == "None" and c is None else c) for i, n, c in components(rows)]
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == want


@pytest.mark.parametrize("batch", [1, 2, 3, 100])
def test_lists_in_small_batches(spark, batch):
    rows = [(t, 0, c, p, 10 + c, s) for t in range(5) for s, p, c in ((1, 0, 7), (1, 0, 7), (2, 0, 7), (3, 1, 7), (4, 5, 8), (5, 6, 8))] + [(9, 0, 7, 0, 10, 4)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = jaccard._shared_lists(spark.createDataFrame(rows, "token bigint, salt int, class int, pos int, n int, sig bigint")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(((r.token, r.sig, r.near, r.hub) for r in got), key=lambda r: r[:2]) == [
        (t, s, near, hub) for t in range(5) for s, near, hub in ((1, None, None), (2, 1, 1), (3, 2, 1), (4, 3, None), (5, 4, 4))]


def test_one_of_each_group(odd, empty):
    kept = jaccard.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 3, 4, 5, 6, 8, 9, 10]
    assert jaccard.keep_one_per_group(empty).count() == 0


def _bridge():
    """Texts a, b, c with a ~ b and b ~ c, but not a ~ c."""
    words = [f"w{k}" for k in range(60)]
    return [" ".join(w) for w in (words, words[4:] + [f"x{k}" for k in range(4)], words[8:] + [f"x{k}" for k in range(8)])]


def test_rows_without_an_id_link_too(spark):
    a, b, c = _bridge()
    rows = [(1, a), (None, b), (3, c), (None, "lone words that have no id and no kin"), (7, "seven"), (7, "quite another text under the same id")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard.similar_documents(docs).collect()), key=str)
    assert got == sorted([(1, 1), (None, 1), (3, 1), (None, None), (7, 7), (7, 7)], key=str)


def test_kept_rows(spark):
    a, b, c = _bridge()
    rows = [(1, a, "x"), (None, b, "x"), (3, c, "x"), (None, "lone words", "x"), (None, "lone words", "y"), (7, "seven", "x"), (7, "seven", "x"),
            (7, "quite another text", "x"), (8, " ", "x"), (8, None, "x")]
    kept = jaccard.keep_one_per_group(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted(
        [(1, a), (None, "lone words"), (7, "seven"), (7, "quite another text"), (8, " "), (8, None)], key=str)


def test_language_sample_of_different_texts(spark):
    docs = table(spark, "documents", SMALL)
    copies = docs.groupBy("lang").agg(F.min("text").alias("text")).where("lang IS NOT NULL").crossJoin(spark.range(300)).select("text", "lang")
    model = langid.train_language_model(docs.select("text", "lang").unionByName(copies))
    told = langid.predict_language(docs.select("text", "lang"), model).where("lang IS NOT NULL")
    assert told.where("lang = lang_pred").count() >= 0.97 * told.count()


def test_word_hashes():
    texts = ["a bb ccc", "", None, "ccc A", "\x00é \n"]
    hashes, counts = hashed_words(texts)
    assert counts.tolist() == [3, 0, 0, 2, 1] and hashes[2] == hashes[3] and hashes[0] == hashes[4] and len(set(hashes.tolist())) == 4


def test_words_are_looked_up_once_and_blocks_keep_their_order(spark, monkeypatch):
    from linecross.llm import lm
    rng = np.random.default_rng(4)
    for unit in ("<u4", "<u8"):
        for order in (1, 2, 3, 4):
            grams, shard = rng.integers(0, 1 << 31, (400, order)).astype(unit) % 9, rng.integers(0, 4, 400)
            assert (lm._ordered(shard, grams) == np.lexsort((*grams.T[::-1], shard))).all()
    texts = [" ".join(rng.choice(list("abcdefgh"), 300)) for _ in range(8)]
    model, folder = lm.train(spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "doc_id long, text string"), shard_tokens=10**6)
    asked, real = {}, lm._look_up

    def look_up(uri, keys, width):
        kind = uri.rsplit("/", 1)[1].rsplit("-", 1)[0]
        asked[kind] = asked.get(kind, 0) + len(keys)
        return real(uri, keys, width)
    monkeypatch.setattr(lm, "_look_up", look_up)
    got = model.score([*texts, "a zz b", "", None])
    assert asked["grams-1"] <= 10 and asked["contexts-2"] <= 10 and (got["score"] < 0).all()
    lm.delete_path(spark, folder)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 5000])
def test_places_in_buckets(n):
    from linecross.llm.common import bucket_starts, places
    rng = np.random.default_rng(n)
    for top in (1 << 64, 1 << 20):  # spread, and all in the first bucket
        table = np.unique(rng.integers(0, top, n, np.uint64))
        asked = np.concatenate([table, rng.integers(0, top, 50, np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        where = {k: i for i, k in enumerate(table.tolist())}
        assert places(table, bucket_starts(table), asked).tolist() == [where.get(k, -1) for k in asked.tolist()]
    assert len(bucket_starts(table)) <= max(2, len(table) // 4)


def test_lookups_are_of_distinct_keys_in_few_files(spark, monkeypatch):
    """Contexts that the order below does not have are not looked up, nor is a key twice; anchors go to fewer files than stretches."""
    from linecross.llm import lm
    model, folder = lm.train(spark.createDataFrame([(0, "a b c d"), (1, "b c e")], "doc_id long, text string"))
    asked, real = {}, lm._look_up

    def look_up(uri, keys, width):
        kind = uri.rsplit("/", 1)[1].rsplit("-", 1)[0]
        asked.setdefault(kind, []).extend(keys.tolist())
        return real(uri, keys, width)
    monkeypatch.setattr(lm, "_look_up", look_up)
    model.score(["a b c d"] * 5 + ["z y x w v u"] * 5)
    assert all(len(keys) == len(set(keys)) for keys in asked.values())
    assert len(asked["grams-3"]) <= 5 and len(asked["contexts-3"]) <= 5
    lm.delete_path(spark, folder)
    tables = substring_dedup.Tables(9)
    assert tables.lookups == 3 and int(tables.lookup_shard(np.arange(1000, dtype=np.uint64)).max()) == 2


def test_blocks_are_near_order():
    from linecross.llm import lm
    rng = np.random.default_rng(8)
    for top in (9, 1 << 30):
        grams, shard = rng.integers(0, top, (3000, 3)).astype("<u4"), rng.integers(0, 5, 3000)
        grams[::7] |= np.uint32(1 << 31)
        order = lm._near_order(shard, grams)
        rows = [(s, g & 0x7FFFFFFF) for s, g in zip(shard[order].tolist(), grams[order][:, 0].tolist())]
        assert rows == sorted(rows) and sorted(order.tolist()) == list(range(3000))


def test_stable_order_by_quick_sorts(monkeypatch):
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 5, 1000):
        word, group = rng.integers(0, 9, n, np.uint64) << np.uint64(60), np.sort(rng.integers(0, n // 3 + 1, n))
        assert (suffix_sort._stable_order(word) == np.argsort(word, kind="stable")).all()
        if n:
            assert (suffix_sort._stable_order(word, group + (1 << 60)) == np.lexsort((word, group))).all()  # more than 64 bits
            with monkeypatch.context() as patch:  # no stable sort of all words otherwise
                patch.setattr(np, "lexsort", None)
                got = suffix_sort._stable_order(word, group)
            assert (got == np.lexsort((word, group))).all()


def test_language_training_holds_rows_once():
    """Training frees each language's counts as it goes; its peak stays near twice the rows it learns from."""
    import tracemalloc
    rng = np.random.default_rng(3)
    counts = {lang: rng.integers(0, 3, (150, langid.BUCKETS)).astype(np.float32) for lang in ("en", "de", "fr", "es", "pl", "fi", "tr", "ar")}
    size = sum(c.nbytes for c in counts.values())
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0]
    model = langid.LanguageModel(counts, 150)
    peak = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert not counts and model.weights.shape[0] == langid.BUCKETS and peak < 2.2 * size


def test_suffix_sort_memory():
    """The arrays beside the sorting take 32 bytes a byte of text at most."""
    import tracemalloc
    text = np.random.default_rng(5).integers(97, 123, 500_000, np.uint8)
    tracemalloc.start()
    places = sum(len(place) for place, _ in suffix_sort.sorted_suffixes(text))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert places == len(text) and peak < 32 * len(text)
