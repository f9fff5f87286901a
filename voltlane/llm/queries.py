"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from voltlane.llm import (
    embedding_dedup,
    language,
    line_dedup,
    mixing,
    nearest,
    ngram_join,
    periodic,
    pieces,
    quality,
    secrets,
    token_counts,
    url_filter,
    vector_codes,
)

QUERIES = {
    "op1_language_id": language.op1,
    "op2_secret_scan": secrets.op2,
    "op3_url_filter": url_filter.op3,
    "op4_token_counts": token_counts.op4,
    "op5_sentencepiece": pieces.op5,
    "op6_embedding_near_dedup": embedding_dedup.op6,
    "op7_line_dedup": line_dedup.op7,
    "op8_nearest": nearest.op8,
    "op9_source_mix": mixing.op9,
    "op10_ngram_join": ngram_join.op10,
    "op11_periodic_runs": periodic.op11,
    "op12_vector_codes": vector_codes.op12,
    "op13_quality": quality.op13,
}
SQL: dict[str, str] = {
    "op2_secret_scan": secrets.SQL,
    "op3_url_filter": url_filter.SQL,
    "op11_periodic_runs": periodic.SQL,
    "op12_vector_codes": vector_codes.SQL,
}
