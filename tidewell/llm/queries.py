"""The operators as queries over the test tables, with SQL where it can express them."""

from tidewell.llm import (
    minhash,
    mixing,
    neighbours,
    overlap,
    phrases,
    pieces,
    pii,
    quality,
    secrets,
    spelling,
    topk,
    toxicity,
    warc,
)

QUERIES = {
    "op1_neighbours": neighbours.op1_neighbours,
    "op2_mixing": mixing.op2_mixing,
    "op3_pieces": pieces.op3_pieces,
    "op4_toxicity": toxicity.op4_toxicity,
    "op5_pii": pii.op5_pii,
    "op6_warc": warc.op6_warc,
    "op7_topk": topk.op7_topk,
    "op8_secrets": secrets.op8_secrets,
    "op9_quality": quality.op9_quality,
    "op10_minhash": minhash.op10_minhash,
    "op11_spelling": spelling.op11_spelling,
    "op12_phrases": phrases.op12_phrases,
    "op13_overlap": overlap.op13_overlap,
}

ORACLE = {
    "op1_neighbours": neighbours.ORACLE_OP1,
    "op2_mixing": mixing.ORACLE_OP2,
    "op6_warc": warc.ORACLE_OP6,
    "op7_topk": topk.ORACLE_OP7,
    "op10_minhash": minhash.ORACLE_OP10,
    "op11_spelling": spelling.ORACLE_OP11,
    "op12_phrases": phrases.ORACLE_OP12,
    "op13_overlap": overlap.ORACLE_OP13,
}
