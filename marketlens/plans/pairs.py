"""Products seen together, as a report and as a keyed table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.operators.pairs import pair_frequency
from marketlens.sources.files import require_non_empty
from marketlens.sources.keyed import upsert_by_key


def product_pairs_report(sessions: DataFrame, max_len: int = 7, **blocks: int) -> DataFrame:
    """Pairs with their frequency, most frequent first."""
    return pair_frequency(sessions, max_len, **blocks).orderBy(F.desc("frequency"), F.asc("id"))


def save_product_pairs(
    sessions: DataFrame, path: str, max_len: int = 7, format: str | None = None, **options: object
) -> int:
    """Upsert the pairs of cleaned sessions into the keyed table at `path`; the number of pairs written.

    `format` and `options` name a store's own connector instead of the table.
    """
    pairs = pair_frequency(require_non_empty(sessions), max_len)
    # Ids of equal length make each joined id belong to one pair.
    return upsert_by_key(pairs, path, "id", format=format, unique=True, **options)
