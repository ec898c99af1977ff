"""The registered corpus queries and their SQL."""

from quillgraph.llm.bpe import op4_bpe
from quillgraph.llm.kdtree import op6_sharding
from quillgraph.llm.langid import op3_langid
from quillgraph.llm.lbl import op8_lbl
from quillgraph.llm.licenses import op9_licenses
from quillgraph.llm.minhash import op2_minhash
from quillgraph.llm.multi_index import op5_multi_index
from quillgraph.llm.packing import op7_packing
from quillgraph.llm.simhash import op10_simhash
from quillgraph.llm.substring import op1_substring

QUERIES = {
    "op1_substring": op1_substring,
    "op2_minhash": op2_minhash,
    "op3_langid": op3_langid,
    "op4_bpe": op4_bpe,
    "op5_multi_index": op5_multi_index,
    "op6_sharding": op6_sharding,
    "op7_packing": op7_packing,
    "op8_lbl": op8_lbl,
    "op9_licenses": op9_licenses,
    "op10_simhash": op10_simhash,
}
#: The other operators rest on hashes, tokenizers or trained models that SQL doesn't have; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op1_substring": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        x as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
        f as (select k, min(doc_id) as low from x group by k),
        gone as (select distinct doc_id, i + o as p from x join f using (k), range(13) t(o) where low < doc_id),
        words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
        kept as (select doc_id, string_agg(word, ' ' order by p) as t, count(*) as n from words anti join gone using (doc_id, p) group by doc_id)
        select doc_id, len(w) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (doc_id)""",
    "op5_multi_index": """
        with recursive e as (select vec_id, label, list_transform(embedding, lambda v: cast(v as double)) as x from embeddings),
        u as (select vec_id, label, list_transform(x, lambda v: v / sqrt(list_dot_product(x, x))) as x from e where list_dot_product(x, x) > 0),
        links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.label = b.label and a.vec_id <> b.vec_id where list_dot_product(a.x, b.x) >= 0.98),
        reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
        low as (select a as vec_id, min(b) as component_id from reach group by a), n as (select a as vec_id, count(*) as n from links group by a)
        select vec_id, coalesce(n, 0) as n_links, component_id, vec_id = component_id as kept from low left join n using (vec_id)""",
}
