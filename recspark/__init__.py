"""recspark: product-recommendation operators on Spark DataFrames.

The operators live in ``recspark.operators`` / ``recspark.functions`` /
``recspark.sources`` / ``recspark.streaming``; the end-to-end jobs and the
endpoint reads in ``recspark.plans``.  The most used entry points are
importable from the package itself; they load on first use, so the Python
workers that unpickle one operator do not import the rest.
"""

from importlib import import_module

_EXPORTS = {
    "recspark.functions.expr": ["filter_rating_logs", "format_rating_event", "normalize_score",
                                "normalize_ts", "parse_rating_events", "rating_month",
                                "split_tags", "user_id_from_name"],
    "recspark.operators.als": ["als_fit", "als_product_recs", "als_user_recs", "blocked_top_k"],
    "recspark.operators.mips": ["norm_top_k"],
    "recspark.operators.online": ["candidate_products", "online_recs", "sim_lookup",
                                  "stream_scores"],
    "recspark.operators.ratings": ["apply_ratings", "recent_ratings"],
    "recspark.operators.recs": ["pack_recs", "top_k_per_key", "unpack_recs"],
    "recspark.operators.serving": ["hydrate_products"],
    "recspark.operators.similarity": ["content_based", "cosine_pairs", "item_cf", "sparse_gram"],
    "recspark.operators.stats": ["average_products", "rate_more_products",
                                 "rate_more_recently_products", "statistics_tables"],
    "recspark.session": ["cluster_conf", "get_session"],
}
_WHERE = {name: mod for mod, names in _EXPORTS.items() for name in names}
__all__ = sorted(_WHERE)


def __getattr__(name):
    if name in _WHERE:
        return getattr(import_module(_WHERE[name]), name)
    raise AttributeError(f"module 'recspark' has no attribute {name!r}")
