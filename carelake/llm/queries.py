"""Queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op9_bpe
from .decontamination import op7_decontamination
from .html_extraction import op13_html_extraction
from .jaccard_join import SQL as JACCARD_SQL, op1_jaccard_join
from .language_id import op3_language_id
from .nn_descent import op4_nn_descent
from .ranked_search import SQL as SEARCH_SQL, op12_ranked_search
from .secrets import SQL as SECRETS_SQL, op10_secret_scan
from .token_alignment import op11_token_alignment
from .token_counts import op5_token_counts
from .token_files import op8_token_files
from .toxicity import op6_toxicity
from .url_filter import op2_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_url_filter": op2_url_filter,
    "op3_language_id": op3_language_id,
    "op4_nn_descent": op4_nn_descent,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_token_files": op8_token_files,
    "op9_bpe": op9_bpe,
    "op10_secret_scan": op10_secret_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_ranked_search": op12_ranked_search,
    "op13_html_extraction": op13_html_extraction,
}
SQL: dict[str, str] = {"op1_jaccard_join": JACCARD_SQL, "op10_secret_scan": SECRETS_SQL,
                       "op12_ranked_search": SEARCH_SQL}
