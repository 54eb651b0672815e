"""The subpackage's queries and the SQL that checks those which SQL can express."""

from __future__ import annotations

from . import centroid_clusters, exact_dedup, hilbert_shards, hmm_scoring, html_extraction, language_id, license_scan, media, minhash_join, packing, piece_encoding, reply_trees, vector_codes

QUERIES = {
    "op1_html_extraction": html_extraction.op1_html_extraction,
    "op2_hmm_scoring": hmm_scoring.op2_hmm_scoring,
    "op3_media_columns": media.op3_media_columns,
    "op4_hilbert_shards": hilbert_shards.op4_hilbert_shards,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_reply_trees": reply_trees.op6_reply_trees,
    "op7_vector_packing": packing.op7_vector_packing,
    "op8_language_id": language_id.op8_language_id,
    "op9_minhash_join": minhash_join.op9_minhash_join,
    "op10_piece_encoding": piece_encoding.op10_piece_encoding,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_centroid_clusters": centroid_clusters.op13_centroid_clusters,
}

ORACLE_SQL = {
    "op5_exact_dedup": exact_dedup.SQL,
    "op6_reply_trees": reply_trees.SQL,
    "op11_vector_codes": vector_codes.SQL,
    "op13_centroid_clusters": centroid_clusters.SQL,
}
