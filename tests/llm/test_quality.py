from __future__ import annotations

import random
import re
from collections import Counter
from importlib import metadata

import numpy as np
import zstandard
from pyspark.sql import functions as F

from rivulet.llm.quality import BASE_FIELDS, Bands, Judge, base_counts, base_failed, keep_good, quality, repeated_words
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i:i + 5])] > 1:
            inside |= set(range(i, i + 5))
    lines, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in lines
            lines.add(x)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_base_counts():
    rng = random.Random(2)
    texts = [t for _, t, *_ in DOCS] + ["a b c d e " * 3, "x\nx \nx\n\n \n", "#*$%&|<> ## ｜"]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for t in texts:
        assert base_counts((t or "").encode()) == brute(t)


def test_repeated_words_with_many_different_words():
    words = [b"%d" % i for i in range(9000)]
    assert repeated_words(words) == 0
    assert repeated_words(words + words[100:110]) == 20


def verdict(text, bands=Bands()):
    """The method written out: nothing of the operator but its parameters."""
    data = (text or "").encode()
    n, *_, again = brute(text)
    if n < 10 or 100 * again > 20 * n:
        return False
    ratio = lambda d: len(d) / len(zstandard.ZstdCompressor(level=bands.level).compress(d))
    sizes = np.log([b[0] for b in bands.whole])
    low, high = (np.interp(np.log(len(text)), sizes, [b[i] for b in bands.whole]) for i in (1, 2))
    if not low <= ratio(data) <= high:
        return False
    step, below, above, chunks, at = bands.chunk_bytes, 0, 0, 0, 0
    while len(data) >= step and at < len(data):
        at = min(at, len(data) - step)
        chunks += 1
        below += ratio(data[at:at + step]) < bands.chunk[0]
        above += ratio(data[at:at + step]) > bands.chunk[1]
        at += step
    return below <= bands.low_share * chunks and above <= bands.high_share * chunks


def test_limits_are_interpolated():
    judge = Judge(Bands(whole=((100, 1.0, 2.0), (400, 2.0, 4.0))))
    assert judge.limits(0) == (1.0, 2.0) and judge.limits(100) == (1.0, 2.0)
    assert judge.limits(200) == (1.5, 3.0) and judge.limits(400) == (2.0, 4.0) and judge.limits(10**9) == (2.0, 4.0)


def test_repetitive_and_random_texts_are_rejected():
    rng = random.Random(4)
    judge = Judge(Bands())
    random_words = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=12))
                            for _ in range(400))
    one_line = " ".join(f"item {i} of the list is the same as any other item of it" for i in range(200))
    assert not judge.accepts(random_words.encode()) and not judge.accepts(one_line.encode())


def test_quality(spark, docs, clashing, empty):
    rows = {r.doc_id: r for r in quality(docs.where("doc_id IS NOT NULL").select("doc_id", "text")).collect()}
    for i, t, *_ in DOCS:
        if i is not None:
            assert tuple(rows[i][c] for c in BASE_FIELDS) == brute(t) and rows[i].kept == verdict(t)
    made = quality(clashing)
    assert "text" not in made.columns and dict(made.dtypes)["kept"] == "boolean" and made.count() == len(DOCS)
    assert quality(empty).count() == 0
    left = keep_good(clashing)
    assert left.columns == clashing.columns
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(str(i) for i, t, *_ in DOCS if verdict(t))
    assert keep_good(empty).count() == 0


def test_whole_table_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = {r.doc_id: r for r in quality(docs.select("doc_id", "text")).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        assert tuple(got[r.doc_id][c] for c in BASE_FIELDS) == brute(r.text)
        assert got[r.doc_id].kept == verdict(r.text)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").where("quality = 1")
    good = {r.doc_id for r in labels.collect()}
    passed_base = [r for r in got.values() if r.doc_id in good and not r.base_failed]
    assert passed_base and all(r.kept for r in passed_base)
    assert docs.where(F.col("doc_id").isNull()).count() == 0


def clean_text(table, lang, n_bytes):
    """Distinct lines of texts labelled good, in a seeded order, joined up to ``n_bytes``."""
    import pyarrow.dataset as ds
    import pyarrow.parquet as pq

    labels = pq.read_table(f"/root/testdata/{table}/labels.parquet", columns=["doc_id", "quality"]).to_pylist()
    good, lines, held = {r["doc_id"] for r in labels if r["quality"] == 1}, {}, 0
    docs = ds.dataset(f"/root/testdata/{table}/documents.parquet")
    for batch in docs.to_batches(columns=["doc_id", "lang", "text"], batch_size=4096):
        for r in batch.to_pylist():
            if r["lang"] == lang and r["doc_id"] in good:
                for x in r["text"].encode().split(b"\n"):
                    if x.strip() and x not in lines:
                        lines[x] = True
                        held += len(x) + 1
        if held > 1.1 * n_bytes:
            break
    assert held > n_bytes
    lines = list(lines)
    random.Random(9).shuffle(lines)
    return b"\n".join(lines)[:n_bytes].decode(errors="ignore").encode()


def test_very_long_clean_texts_stay():
    judge = Judge(Bands())
    for lang in ("de", "en", "es", "fr"):
        for table, n_bytes in (("sf0.1", 100_000), ("sf0.1", 300_000), ("sf0.1", 700_000)):
            text = clean_text(table, lang, n_bytes)
            assert judge.accepts(text), (lang, n_bytes, judge.ratio(text))
    # a text that says the same in other words is still too repetitive at any length
    rng = random.Random(6)
    names = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    for n in (3_000, 30_000):
        again = " ".join(f"the {rng.choice(names)} of the list is the same as any other {rng.choice(names)}" for _ in range(n))
        assert not judge.accepts(again.encode())


def test_texts_with_incompressible_lines_go():
    import base64

    rng, judge = random.Random(7), Judge(Bands())
    pool = clean_text("sf0.1", "en", 1_000_000)
    for n_bytes in (2_000, 5_000, 7_000, 15_000, 30_000, 200_000):
        for share in (0.3, 0.4):
            for _ in range(10):
                at = rng.randrange(len(pool) - n_bytes)
                clean = pool[at:at + n_bytes]
                assert judge.accepts(clean)
                noise = base64.encodebytes(rng.randbytes(int(n_bytes * share / (1 - share) * 0.74)))
                assert not judge.accepts(clean + b"\n" + noise), (n_bytes, share)
    # the last, partial chunk counts
    clean = pool[:2 * 2048]
    assert judge.chunks_outside(clean + base64.encodebytes(rng.randbytes(1200))) == (3, 1)


PROSE = [
    # documentation, in several languages and scripts
    "Before you start the service, copy the sample settings and change the two lines that name the data folder and the "
    "port. The service refuses to start while either is missing, and says which. Logs go to the folder that the second "
    "section names; they are rotated every night and kept for a fortnight. If you upgrade from an older release, run the "
    "migration once with nobody connected: it takes a few minutes for every million records, and can be repeated safely "
    "when it stops half-way. Backups are plain archives. To restore one, stop the service, unpack it next to the data "
    "folder, and swap the names. Questions are welcome on the mailing list; please say which release you use.",
    "Antes de empezar, copie el fichero de ejemplo y cambie las dos líneas que indican la carpeta de datos y el puerto. "
    "El servicio no arranca si falta alguna de ellas y explica cuál. Los registros se guardan en la carpeta que aparece "
    "en la segunda sección, se renuevan cada noche y se conservan dos semanas. Si viene de una versión anterior, ejecute "
    "la migración una sola vez y sin usuarios conectados; tarda unos minutos por cada millón de filas y puede repetirse "
    "sin riesgo cuando se interrumpe. Las copias de seguridad son archivos corrientes y se restauran con el servicio parado.",
    "启动服务之前，请先复制示例配置文件，并修改其中的数据目录和端口两行。如果缺少任何一项，服务将拒绝启动并给出提示。日志写入第二节所指定的目录，"
    "每天夜里轮换一次，保留两个星期。若从旧版本升级，请在无人连接时运行一次迁移程序；每百万条记录大约需要几分钟，中途停止后可以安全地重新执行。"
    "备份是普通的压缩包，恢复时先停止服务，把它解压到数据目录旁边，再交换两个目录的名字即可。",
    "サービスを起動する前に、見本の設定ファイルを複写し、データの置き場所とポート番号の二行を書き換えてください。どちらかが欠けていると起動せず、"
    "足りない項目が表示されます。記録は二つ目の節で指定したフォルダーに書き込まれ、毎晩入れ替わり、二週間保存されます。古い版から更新する場合は、"
    "誰も接続していないときに移行処理を一度だけ実行してください。途中で止まっても、もう一度安全に実行できます。",
    # a licence of the short kind
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
    "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT.",
]


def test_real_prose_stays():
    judge = Judge(Bands())
    for text in PROSE:
        assert judge.accepts(text.encode()), (text[:40], judge.ratio(text.encode()))
    # licences and descriptions of the installed packages, whole and cut
    found = 0
    for package in ("numpy", "pandas", "pyarrow", "pytest", "hypothesis", "duckdb", "tokenizers", "py4j"):
        try:
            dist = metadata.distribution(package)
        except metadata.PackageNotFoundError:
            continue
        texts = [dist.metadata.get_payload() or ""] + [
            f.read_text(encoding="utf-8") for f in dist.files or () if re.search(r"(?i)licen[cs]e[^/]*(\.txt|\.md)?$", str(f))
            and f.locate().is_file() and f.locate().stat().st_size < 200_000]
        for text in texts:
            data = text.encode()
            if 600 <= len(data) and not base_failed(len(data.split()), repeated_words(data.split())):
                found += 1
                assert judge.accepts(data), (package, len(data), judge.ratio(data), judge.chunks_outside(data))
    assert found >= 3


def test_length_is_in_characters():
    bands = Bands(whole=((100, 1.2, 3.0), (300, 1.4, 3.0)))
    text = PROSE[2][:100]
    assert len(text.encode()) > 250 and Judge(bands).accepts(text.encode()) == (Judge(bands).ratio(text.encode()) >= 1.2)
