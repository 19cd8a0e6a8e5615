"""Texts of no learned language go, clean ones stay, and an odd labelled row does not move the cut."""

import base64
import random

from payfeed.llm import language

ITALIAN = "Nel mezzo del cammin di nostra vita mi ritrovai per una selva oscura che la diritta via era smarrita. Tutti gli esseri umani nascono liberi ed eguali in dignita e diritti. "
FINNISH = "Kaikki ihmiset syntyvat vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu jarki ja omatunto, ja heidan on toimittava toisiaan kohtaan veljeyden hengessa. "
TURKISH = "Butun insanlar hur, haysiyet ve haklar bakimindan esit dogarlar. Akil ve vicdana sahiptirler ve birbirlerine karsi kardeslik zihniyeti ile hareket etmelidirler. "


def noise():
    rng = random.Random(3)
    out = [ITALIAN, FINNISH, TURKISH, ITALIAN * 4, FINNISH * 4, TURKISH * 4]
    for n in (200, 2000, 8000):
        out.append(base64.b64encode(rng.randbytes(n)).decode())
        out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)))
        out.append("".join(rng.choice("abcdefghijklmnopqrstuvwxyz   ") for _ in range(n)))
        out.append("d41d8cd98f00b204e9800998ecf8427e" * (n // 32))
    return out


def test_noise_and_other_languages_go_and_held_out_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    odd = spark.createDataFrame([(-i, "zqxj" * 40, la) for i, la in enumerate(["en", "de", "fr", "es"], 1)], "doc_id long, text string, lang string")
    model = language.train(docs.filter(~language.held_out()).select("doc_id", "text", "lang").union(odd))
    far = language.predict(spark.createDataFrame(list(enumerate(noise())), "doc_id long, text string"), model, ["doc_id"]).collect()
    assert [r.doc_id for r in far if not r.rejected] == []
    held = language.predict(docs.filter(language.held_out()), model, ["doc_id"]).collect()
    assert sum(r.rejected for r in held) <= 0.003 * len(held)
