"""Registered queries of the text operators: thin digests over whole tables, and their DuckDB text."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import decontaminate, html_text, infill, language_id, licenses, ngram_jaccard, packing, pieces, quality, ranked_search, spotsigs, toxicity, warc
from .common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Place of an installed public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn

    return deco


@query("op2_ngram_jaccard", r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') as ws from documents),
s as (
  select doc_id, unnest(case when len(ws) = 0 then []
         when len(ws) < 4 then [array_to_string(ws, ' ')]
         else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as g from w),
d as (select distinct doc_id, g from s),
n as (select doc_id, count(*) as n from d group by 1),
o as (select a.doc_id as a, b.doc_id as b, count(*) as c from d a join d b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
e as (select a, b from l union select b, a from l),
r as (select doc_id as node, doc_id as seen from n union select r.node, e.b from r join e on e.a = r.seen),
m as (select node, min(seen) as component_id from r group by 1)
select documents.doc_id, coalesce(n.n, 0)::bigint as n_shingles, coalesce(m.component_id, documents.doc_id) as component_id
from documents left join n using (doc_id) left join m on m.node = documents.doc_id
""")
def op2_ngram_jaccard(spark, sf_dir):
    """Every document of ``documents``: 4-word shingles, links at a Jaccard likeness of 85 in 100."""
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100).select(
        "doc_id", "n_shingles", "component_id")


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """Language of every document, learned only outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.held_out(F.col("doc_id"))
    samples = language_id.training_sample(docs.where(~out))
    return language_id.identify(docs.select("doc_id", "text", out.alias("held_out")), samples).select(
        "doc_id", "held_out", "lang_pred", "score")


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


@query("op5_sentencepiece")
def op5_sentencepiece(spark, sf_dir, model: str = VOCABULARY):
    """Every document encoded with merge dropout, decoded again and compared with the original."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = pieces.load_vocabulary(model)
    both = pieces.encode(docs, vocabulary, lossless_col="lossless", drop_text=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", "lossless")


@query("op6_quality")
def op6_quality(spark, sf_dir):
    """Importance weight of every document and whether the Gumbel top-k draw keeps it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.resample(docs, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "n_grams", "kept")


@query("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    """Expected severity of every document, and whether it counts as toxic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "severity", "p_toxic", "grade", "toxic")


@query("op9_html_text")
def op9_html_text(spark, sf_dir):
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.main_text(pages).select("page_id", "url", "text", "n_chars")


@query("op3_warc", """
with p as (select page_id, coalesce(html, '') as body from pages),
d as (select page_id, strlen(body)::bigint as payload_bytes, sha1(body) as payload_digest from p),
m as (select payload_digest, max(page_id) as last from d where payload_bytes >= 1000 group by 1)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when m.last is not null and m.last <> d.page_id then 'revisit' else 'response' end as record_type,
       case when m.last is not null and m.last <> d.page_id then m.last end as refers_to
from d left join m using (payload_digest)
""")
def op3_warc(spark, sf_dir):
    """Every page written to archives, normalised, and read back through the index."""
    records = warc.read_archives(warc.archive(table(spark, sf_dir, "pages")))
    return records.select(warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          warc.page_of(F.col("refers_to")).alias("refers_to"))


@query("op7_decontaminate")
def op7_decontaminate(spark, sf_dir):
    """Every (document, benchmark item) whose alignment keeps enough of an exact copy's score."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op1_licenses")
def op1_licenses(spark, sf_dir):
    """Every license notice found in the documents, with the share of its shingles that the text has."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_spotsigs")
def op10_spotsigs(spark, sf_dir):
    """Fingerprint of every document and of its edited text, and their likeness."""
    return spotsigs.edit_test(table(spark, sf_dir, "documents"))


@query("op11_packing")
def op11_packing(spark, sf_dir, vocabulary: str | None = None):
    """Every document tokenised and packed into sequences of at most 4096 tokens; a row per piece."""
    packed = packing.pack(table(spark, sf_dir, "documents"), packing.read_vocabulary(vocabulary or tokenizer_path("word_bpe_49k.json")))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op13_fill_in_middle", r"""
with t as (select doc_id, coalesce(text, '') as text, sha256('7:' || doc_id::varchar) as h from documents),
u as (select *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') as us, ('0x' || h[1:8])::bigint as h1, ('0x' || h[9:16])::bigint as h2,
        ('0x' || h[17:24])::bigint as h3, ('0x' || h[25:32])::bigint as h4 from t),
c as (select *, len(us) as n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) as a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) as b,
        case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 100 then 'plain'
             when h4 % 100 < 50 then 'spm' else 'psm' end as form from u),
p as (select *, coalesce(array_to_string(us[1:a], ''), '') as p, coalesce(array_to_string(us[a + 1:b], ''), '') as m,
        coalesce(array_to_string(us[b + 1:n], ''), '') as s from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then length(p)::bigint end as prefix_chars,
       case when form <> 'plain' then length(m)::bigint end as middle_chars,
       sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(text) as restored_sha256
from p
""")
def op13_fill_in_middle(spark, sf_dir):
    """Every document cut in lines and reordered; digests of the output and of the text rebuilt from it."""
    return infill.digests(infill.transform(infill.store(table(spark, sf_dir, "documents"))))


@query("op12_ranked_search", r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts from documents),
n as (select doc_id, ts, len(ts)::bigint as n from d where len(ts) > 0),
a as (select count(*)::bigint as docs, sum(n)::bigint as total from n),
m as (select doc_id, ts, 25 + (75 * n * docs) // total as m from n, a),
q as (select item_id, term, count(*)::bigint as repeats from (select item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark) group by all),
p as (select doc_id, m, term, count(*)::bigint as tf from (select doc_id, m, unnest(ts) as term from m)
      where term in (select term from q) group by all),
w as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w
      from (select term, count(*)::bigint as df from p group by term), a),
s as (select item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
      from q join w using (term) join p using (term) group by all)
select item_id, rank::int as rank, doc_id, score from (
  select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from s where score > 0) where rank <= 10
""")
def op12_ranked_search(spark, sf_dir):
    """The 10 highest-scoring documents of every benchmark item."""
    return ranked_search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
