"""Media, decontamination, token counts, packing and urls against plain versions of the same contract."""

from __future__ import annotations

import hashlib
import os
import re
import zlib

import duckdb
import numpy as np
import pytest

from docpipe.llm import decontam, media, packing, queries, tokencount, urlfilter

from .helpers import documents, odd_rows, prose, with_clashes

os.environ["TOKENIZERS_PARALLELISM"] = "false"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    return [r for r in rows if r[0] is not None]


def test_media(spark):
    rows = odd_rows() + [(1, "y" * 192), (2, "y" * 193)]
    got = media.media_digest(with_clashes(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, text in plain(rows):
        data = (text or "").encode()
        payload = data + b" " * (-len(data) % 192) or b" " * 192
        r = by[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(data), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.media_bytes == len(media.encode(payload))
    assert by[1000].media_sha256 == by[1001].media_sha256
    whole = media.media_columns(documents(spark, [(1, "abc")])).first()
    assert media.decode(whole.media) == media.pad(b"abc")


def test_fingerprints_follow_the_sound():
    t = np.arange(192 * 40)
    tone = lambda f: bytes((128 + 90 * np.sin(2 * np.pi * f * t / 192) * (1 + 0.3 * np.sin(t / 300))).astype(np.uint8))
    for f in (10, 37):
        peaks = media.spectral_peaks(tone(f))
        strength = media.magnitudes(tone(f))[peaks[:, 0], peaks[:, 1]]
        strong = peaks[strength > strength.max() / 4]
        assert len(strong) > 3 and (strong[:, 1] == f).all()
    prints = media.fingerprints(np.array([[0, 5], [4, 6], [9, 7], [9, 8], [41, 3], [42, 4]]))
    assert prints.tolist() == [[0, 5, 6, 4], [0, 5, 7, 9], [0, 5, 8, 9], [4, 6, 7, 5], [4, 6, 8, 5], [9, 7, 3, 32], [9, 8, 3, 32], [41, 3, 4, 1]]
    far = media.fingerprints(np.array([[0, 5], [300, 6]]), reach=5000)
    assert media.pair_codes(far).tolist() == [5 << 40 | 6 << 32 | 300]


def slow_peaks(samples):
    """The peaks by their definition: a discrete Fourier sum and four comparisons a cell."""
    x = np.frombuffer(samples, np.uint8).astype(float) - 128
    n = (len(x) - 192) // 96 + 1
    wave = np.exp(-2j * np.pi * np.outer(np.arange(192), np.arange(97)) / 192)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(192) / 191)
    power = np.array([np.abs((x[i * 96 : i * 96 + 192] * window) @ wave) for i in range(n)])
    power[:, :2] = 0
    at = lambda i, k: power[i, k] if 0 <= i < n and 0 <= k < 97 else -1.0
    out = []
    for i in range(n):
        cells = [k for k in range(97) if power[i, k] > 0 and power[i, k] > max(at(i - 1, k), at(i, k - 1)) and power[i, k] >= max(at(i + 1, k), at(i, k + 1))]
        out += sorted((i, k) for k in sorted(cells, key=lambda k: -power[i, k])[: media.PEAKS])
    return out


@pytest.mark.parametrize("chunk", [media._CHUNK, 5])
def test_peaks_by_definition(monkeypatch, chunk):
    monkeypatch.setattr(media, "_CHUNK", chunk)
    for text in (prose(3, 400), "é日本 " * 200, "", "a b c. " * 90):
        payload = media.pad(text.encode())
        peaks = media.spectral_peaks(payload)
        want = slow_peaks(payload)
        got = [tuple(p) for p in peaks.tolist()]
        assert len(set(got) ^ set(want)) <= len(want) // 50 + (len(set(payload)) == 1)  # 32-bit magnitudes tie where 64-bit ones don't
        brute = []
        for i, (f, k) in enumerate(got):
            later = [(g, m) for g, m in got if g > f][: media.FAN_OUT]
            brute += [[f, k, m, g - f] for g, m in later if g - f <= media.REACH]
        assert media.fingerprints(peaks).tolist() == brute


def brute_hits(text, items):
    words = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        w = WORD.findall((body or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            win = w[k : k + 10]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit |= set(range(p, p + len(win)))
                    found.add(str(item))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


ITEMS = [(1, prose(50, 30)), (2, prose(51, 10)), (11, "Short Item!"), (3, prose(50, 30)), (4, ""), (5, None), (6, "é—ñ 日本 x"), (7, "a a a a a a a a a a a")]


@pytest.mark.parametrize("block, spots", [(decontam.BLOCK_CHARS, 1), (200, decontam.SPOT_WINDOWS), (200, 7)])
def test_decontamination(spark, monkeypatch, block, spots):
    monkeypatch.setattr(decontam, "BLOCK_CHARS", block)
    monkeypatch.setattr(decontam, "SPOT_WINDOWS", spots)
    item = prose(50, 30)
    rows = [r for r in odd_rows() if r[1] is None or len(r[1]) < 50_000] + [
        (1, prose(1, 50) + "\n" + item.upper().replace(" ", ", ") + " " + prose(2, 50)),
        (2, "x short-item y short item"),
        (3, " ".join(item.split()[:9])),
        (4, " ".join(item.split()[5:17]) + " " + prose(51, 10)),
        (5, "É—Ñ é ñ 日本 x 日本 x"),
    ]
    docs = with_clashes(documents(spark, rows)).repartition(5)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.contamination_digest(docs, bench).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *brute_hits(t, ITEMS)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == want
    clean = decontam.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.select("doc_id").collect()) == sorted(w[0] for w in want if not w[5])


def test_decontamination_offsets(spark):
    text = "Say:  " + prose(50, 30) + " done."
    row = decontam.contamination(documents(spark, [(1, text)]), spark.createDataFrame(ITEMS[:1], "item_id long, text string")).first()
    assert text.encode()[row.bytes_from[0] : row.bytes_to[0]].decode() == prose(50, 30).rstrip(".")
    none = spark.createDataFrame([], "item_id long, text string")
    assert not decontam.contamination_digest(documents(spark, [(1, text)]), none).first().contaminated


def test_sql_of_decontamination(spark, sf_dir):
    c = duckdb.connect()
    for name in ("documents", "benchmark"):
        c.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    got = queries.op4_benchmark_decontamination(spark, sf_dir).toPandas().sort_values("doc_id").reset_index(drop=True)
    want = c.sql(decontam.CONTAMINATION_SQL).df().sort_values("doc_id").reset_index(drop=True)[list(got.columns)]
    assert got.equals(want)


def test_token_counts(spark):
    from tokenizers import Tokenizer, models, pre_tokenizers

    path = queries.tokenizer_path("piece_bpe_32k.model")
    pieces = tokencount.vocabulary(path)
    ref = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    ref.pre_tokenizer = pre_tokenizers.Metaspace(replacement=tokencount.SPACE, prepend_scheme="always", split=True)
    rows = odd_rows() + [(1, "  two  blanks "), (2, "▁ mark"), (3, "<s> <0x41> tab\tx")]
    got = tokencount.token_counts(with_clashes(documents(spark, rows)), path).collect()
    want = sorted((str(i), len(ref.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens) for r in got) == want


def test_token_count_ties():
    c = tokencount.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -1.0), ("bc", -2.0), ("▁", 0.0)])
    assert c.part("▁abc")[1] == -3.0
    assert c.part("▁abc")[0] == 3  # ▁ ab c: the piece that begins earlier wins the tie at b


@pytest.mark.parametrize("slot_rows", [packing.SLOT_ROWS, 3])
def test_packing(spark, monkeypatch, slot_rows):
    monkeypatch.setattr(packing, "SLOT_ROWS", slot_rows)
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    ref = Tokenizer.from_file(path)
    rows = odd_rows() + [(i, prose(i, 1 + (i * 37) % 1500)) for i in range(60)] + [(900, "Été don't a.b x.. <|endoftext|> ＡＢ ﬁ a\u0301 ²"), (901, "Word, word; WORD! word? Word.")]
    got = packing.pack_documents(with_clashes(documents(spark, rows)), path).collect()
    want = []
    for i, t in rows:
        ids = [*ref.encode(t or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a : a + 2048], "<u4")
            want.append((str(i), k, a, len(part), zlib.crc32(part.tobytes())))
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    filled: dict[int, int] = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert filled.get(r.sequence_id, 0) == r.offset
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 2048
    assert len(filled) <= np.ceil(sum(r.length for r in got) / 2048) * 1.03 + 1
    assert packing.pack_documents(documents(spark, []), path).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_against_one_by_one(seed):
    import bisect

    rng = np.random.default_rng(seed)
    sizes = sorted((int(x) for x in np.clip(rng.lognormal(5 + seed / 3, 1, 3000), 1, 2048)), reverse=True)
    gaps, n = [], 0
    for s in sizes:
        k = bisect.bisect_left(gaps, s)
        gap = gaps.pop(k) if k < len(gaps) else 2048
        n += gap == 2048
        if gap > s:
            bisect.insort(gaps, gap - s)
    counts = {s: sizes.count(s) for s in set(sizes)}
    used: dict[int, int] = {}
    placed: dict[int, int] = {}
    for size, a, b, first, each, offset in packing.best_fit_runs(counts):
        placed[size] = placed.get(size, 0) + b - a
        for r in range(b - a):
            q = first + r // each
            assert used.get(q, 0) == offset + r % each * size or used.get(q, 0) <= offset + r % each * size
            used[q] = max(used.get(q, 0), offset + (r % each + 1) * size)
    assert placed == counts and max(used.values()) <= 2048
    assert len(used) <= n * 1.002 + 1


def brute_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    host, path = host.translate(LOWER), slash + path
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (r.host.count("."), len(r.path), r.kind), default=None) if host else None
    return host, path, best and best.name, best.kind if best else "allow"


URLS = [
    None, "", "nothing", "http://", "http:///p", "https://Example.ORG", "https://example.org/", "https://a.example.org/es/1", "https://example.org/en/1x",
    "https://example.org/en/2", "https://notexample.org/es/", "http://x.com/fr/?a#b", "http://com/de/", "http://x.com/de", "http://x.com#/fr/", "http://y.net/a/b/c",
    "ftp://é.ORG/ü", "http://example.org/es", "http://example.org:80/es/", "a://b://c.org/x", "http://x.org/a\nb?q",
]
MORE = (*urlfilter.RULES, urlfilter.Rule("block", "org", "/"), urlfilter.Rule("allow", "y.net", "/a/b"), urlfilter.Rule("block", "net", "/a/b/c"), urlfilter.Rule("allow", "y.net", ""))


@pytest.mark.parametrize("rules", [urlfilter.RULES, MORE, ()])
def test_urls(spark, rules):
    df = with_clashes(spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.org/"), (6, URLS[6])], "page_id long, url string"))
    got = urlfilter.url_verdicts(df, rules).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        if r.page_id is not None:
            assert (r.host, r.path, r.rule, r.verdict) == brute_verdict(URLS[r.page_id], rules), URLS[r.page_id]
    joined = urlfilter._joined(df.select("page_id", "url"), list(rules), "allow").collect() if rules else got
    key = lambda r: tuple(map(str, (r.page_id, r.host, r.path, r.rule, r.verdict)))
    assert sorted(map(key, joined)) == sorted(map(key, got))


def test_sql_of_urls(spark, sf_dir):
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{sf_dir}/pages.parquet'")
    got = queries.op10_url_filters(spark, sf_dir).toPandas().sort_values("page_id").reset_index(drop=True)
    want = c.sql(urlfilter.URL_SQL).df().sort_values("page_id").reset_index(drop=True)[list(got.columns)]
    assert got.fillna("").equals(want.fillna(""))
