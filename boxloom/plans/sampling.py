"""From a product catalog to a category sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxloom.operators import catalog, groups
from boxloom.operators import sampling as S
from boxloom.session import checkpointed


def category_sample(
    products: DataFrame,
    rules: list[catalog.Rule],
    image: str,
    additional: str | None,
    category: str,
    gender: str | None,
    total: int,
    smallest: int = 20,
    largest: int = 400,
    fixed: dict[str, object] | None = None,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(sample, report): expand images, apply rules, budget the categories, draw.

    An image that several products share is kept once, in its first category.
    """
    pool = catalog.matched_rules(catalog.expanded_images(products, image, additional), rules, category, gender)
    # The pool is counted, ranked and drawn from: it is written once.
    pool = checkpointed(pool.withColumn("_row", F.concat_ws("|", F.col("product_id"), F.col("im_url"))))
    pools = checkpointed(catalog.pool_size(pool))
    budgets = checkpointed(S.category_budget(pools, total, smallest, largest, fixed))
    drawn = S.stratified_sample(pool, budgets, "_row", "category_clean", seed)
    keep = ["product_id", "category_clean", "matched_rule", "im_url"]
    keep += [c for c in ("gender", "title", "colour", "brand") if c in drawn.columns]
    drawn = drawn.withColumn("_at", F.struct("category_clean", "rank"))
    unique = groups.first_per_key(drawn.select(*keep, "_at"), ["im_url"], ["_at"]).drop("_at")
    return unique.withColumnRenamed("category_clean", "category"), S.budget_report(budgets)
