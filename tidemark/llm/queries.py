"""Queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from .chat import OP9_SQL, op9_chat_format
from .concurrency import OP11_SQL, op11_peak_concurrency
from .decontaminate import op1_decontaminate
from .embeddings import OP7_SQL, op7_embedding_dedup
from .fim import OP12_SQL, op12_fill_in_middle
from .licences import OP10_SQL, op10_licence_scan
from .mixing import OP5_SQL, op5_mix_sources
from .ngram_join import OP8_SQL, op8_ngram_join
from .ppm import op4_ppm_scores
from .substrings import OP2_SQL, op2_substring_dedup
from .toxicity import op6_toxicity
from .urls import op3_url_filter
from .winnow import op13_fingerprints

QUERIES = {"op7_embedding_dedup": op7_embedding_dedup, "op3_url_filter": op3_url_filter, "op10_licence_scan": op10_licence_scan, "op6_toxicity": op6_toxicity, "op1_decontaminate": op1_decontaminate, "op4_ppm_scores": op4_ppm_scores, "op2_substring_dedup": op2_substring_dedup, "op8_ngram_join": op8_ngram_join, "op5_mix_sources": op5_mix_sources, "op9_chat_format": op9_chat_format, "op11_peak_concurrency": op11_peak_concurrency, "op12_fill_in_middle": op12_fill_in_middle, "op13_fingerprints": op13_fingerprints}
ORACLES = {"op7_embedding_dedup": OP7_SQL, "op10_licence_scan": OP10_SQL, "op2_substring_dedup": OP2_SQL, "op8_ngram_join": OP8_SQL, "op5_mix_sources": OP5_SQL, "op9_chat_format": OP9_SQL, "op11_peak_concurrency": OP11_SQL, "op12_fill_in_middle": OP12_SQL}
