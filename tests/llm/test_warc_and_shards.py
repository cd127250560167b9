import hashlib
import random

from pyspark.sql import functions as F

from driftlog.llm import extendible_sharding as sharding
from driftlog.llm import warc_normalise as warc
from driftlog.llm.common import new_folder, read_file

PAGES = "page_id long, url string, html string, digest string, type string"


def page_rows():
    big, small = "<p>" + "é" * 200 + "</p>", "tiny"
    rows = [(5, "http://a/1", big), (3, "http://a/\r\nX: 1", big), (9, None, big), (9, None, big), (4, "u", small), (2, "u", small),
            (7, "u", ""), (8, "u", None), (None, "u", big), (None, None, None), (11, "u", "WARC/1.1\r\n\r\n" * 50), (12, "u", "z" * 300_000)]
    return [(*r, "d", "t") for r in rows]


def test_round_trip(spark):
    rows = page_rows()
    got = sorted((tuple(r) for r in warc.round_trip(spark.createDataFrame(rows, PAGES).repartition(3)).collect()), key=repr)
    want = []
    for page, _, html, *_ in rows:
        raw = (html or "").encode()
        first = min((r[0] for r in rows if (r[2] or "") == (html or "") and r[0] is not None), default=None)
        again = page is not None and len(raw) >= 100 and page != first
        want.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first if again else None))
    assert got == sorted(want, key=repr)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_one_member_per_record_and_a_whole_index(spark):
    """Archives roll; each record of the normalised file inflates alone; members follow each other without gaps."""
    import zlib
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"<p>{i}</p>" * 50, None, None) for i in range(40)], PAGES).coalesce(2)
    raw, clean = new_folder(spark, "raw"), new_folder(spark, "clean")
    archives = warc.write_archives(warc.record_plan(pages), raw, archive_bytes=3000)
    assert archives.count() > 2
    data = read_file(archives.first().file)
    unzip = zlib.decompressobj(31)
    unzip.decompress(data)
    assert unzip.eof and not unzip.unused_data  # one stream over the whole file
    files = warc.normalise(archives, clean)
    index = warc.read_index(spark, clean)
    assert index.where("type != 'warcinfo'").count() == 40 and files.agg(F.sum("n_records")).first()[0] == index.count()
    for f in files.collect():
        rows = index.where(F.col("file") == f.file).orderBy("offset").collect()
        at = 0
        for r in rows:
            assert r.offset == at
            one = zlib.decompressobj(31)
            text = one.decompress(read_file(r.file, r.offset, r.length))
            assert one.eof and not one.unused_data and text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
            at += r.length
        assert at == len(read_file(f.file))


def slow_shards(rows, limit):
    def bits(key):
        h = hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()
        return f"{int(h[:15], 16):060b}{int(h[15:30], 16):060b}"
    out, todo = {}, [("", [(bits(k), s, k) for k, s in rows])]
    while todo:
        p, inside = todo.pop()
        total = sum(x[1] for x in inside)
        if total <= limit or len(inside) == 1 or len({x[0] for x in inside}) == 1:
            for x in inside:
                out.setdefault(x[2], []).append((p, len(inside), total))
        else:
            for b in "01":
                some = [x for x in inside if x[0][len(p)] == b]
                if some:
                    todo.append((p + b, some))
    return out


def test_only_large_buckets_split(spark):
    rnd = random.Random(1)
    rows = [(i, "x" * rnd.randrange(0, 60)) for i in range(300)] + [(1000, "y" * 900), (None, None), (None, "z" * 10)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bytes int").repartition(3)
    for limit in (100, 1000, 10 ** 6):
        got = {}
        for r in sharding.assign(df, limit).collect():
            got.setdefault(r.doc_id, []).append((r.shard, r.shard_rows, r.shard_bytes))
            assert r.depth == len(r.shard)
            if r.shard_bytes > limit:
                assert r.shard_rows == 1
        assert got == slow_shards([(k, len((t or "").encode())) for k, t in rows], limit)


def test_one_hot_key_is_dealt_over_pieces(spark):
    rows = [(7, f"{i:05d}" * 10) for i in range(200)] + [(i, "a") for i in range(100, 130)]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 1000).collect()
    hot = [r for r in got if r.doc_id == 7]
    assert len(hot) == 200 and len({r.shard for r in hot}) == 1 and len({r.piece for r in hot}) > 5
    assert all(r.piece == 0 for r in got if r.doc_id != 7 and r.shard != hot[0].shard)


def test_no_rows(spark):
    assert sharding.assign(spark.createDataFrame([], "doc_id long, text string")).count() == 0
