"""Baskets, itemsets and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingloom.functions.staging import stage
from ratingloom.operators import matrix, rules
from ratingloom.plans.registry import query

SUPPORT, CONFIDENCE = 0.05, 0.3


def baskets(star):
    return stage(rules.transactions(star.brand_ratings))


def itemsets(star):
    return stage(rules.frequent_itemsets(baskets(star), SUPPORT))


def strong_rules(found):
    sets = stage(rules.frequent_itemsets(found, SUPPORT))
    return stage(rules.association_rules(sets, CONFIDENCE))


@query("transactions", """
WITH liked AS (SELECT DISTINCT "userId", coalesce(title, 'Movie_' || "movieId") AS item
               FROM ratings LEFT JOIN movies USING ("movieId") WHERE rating >= 4),
s AS (SELECT "userId", count(*) AS basket_size FROM liked GROUP BY 1 HAVING count(*) >= 2)
SELECT "userId", item, basket_size FROM liked JOIN s USING ("userId")
""")
def transactions(star):
    named = matrix.map_lookup(
        star.ratings, star.movies, "movieId", "title",
        F.concat(F.lit("Movie_"), F.col("movieId").cast("string")))
    return rules.transactions(named, "title")


SETS = """
WITH t AS MATERIALIZED (
  SELECT DISTINCT "userId", item FROM brand_ratings WHERE rating >= 4
  QUALIFY count(DISTINCT item) OVER (PARTITION BY "userId") >= 2),
size AS (SELECT count(DISTINCT "userId") AS n FROM t),
one AS (SELECT item AS a, count(*) AS freq FROM t, size GROUP BY 1
        HAVING count(*) >= 0.05 * any_value(n)),
two AS (SELECT x.item AS a, y.item AS b, count(*) AS freq FROM t x JOIN t y USING ("userId"), size
        WHERE x.item < y.item GROUP BY 1, 2 HAVING count(*) >= 0.05 * any_value(n)),
three AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq
          FROM t x JOIN t y USING ("userId") JOIN t z USING ("userId"), size
          WHERE x.item < y.item AND y.item < z.item GROUP BY 1, 2, 3
          HAVING count(*) >= 0.05 * any_value(n)),
b AS MATERIALIZED (SELECT "userId", list(item ORDER BY item) AS items FROM t GROUP BY 1),
four AS MATERIALIZED (
  SELECT list_append(p.items, x.item) AS items, count(*) AS freq
  FROM (SELECT [a, b, c] AS items FROM three) AS p JOIN b ON list_has_all(b.items, p.items)
  JOIN t x ON x."userId" = b."userId" AND x.item > p.items[-1], size
  GROUP BY 1 HAVING count(*) >= 0.05 * any_value(n)),
five AS MATERIALIZED (
  SELECT list_append(p.items, x.item) AS items, count(*) AS freq
  FROM four p JOIN b ON list_has_all(b.items, p.items)
  JOIN t x ON x."userId" = b."userId" AND x.item > p.items[-1], size
  GROUP BY 1 HAVING count(*) >= 0.05 * any_value(n)),
six AS MATERIALIZED (
  SELECT list_append(p.items, x.item) AS items, count(*) AS freq
  FROM five p JOIN b ON list_has_all(b.items, p.items)
  JOIN t x ON x."userId" = b."userId" AND x.item > p.items[-1], size
  GROUP BY 1 HAVING count(*) >= 0.05 * any_value(n)),
sets AS MATERIALIZED (
  SELECT items, freq, freq / CAST(n AS DOUBLE) AS support FROM (
    SELECT [a] AS items, freq FROM one UNION ALL SELECT [a, b], freq FROM two
    UNION ALL SELECT [a, b, c], freq FROM three UNION ALL SELECT items, freq FROM four
    UNION ALL SELECT items, freq FROM five UNION ALL SELECT items, freq FROM six) AS u, size)
"""
RULES = SETS + """,
masks AS (SELECT items, support, unnest(range(1, (1 << len(items)) - 1)) AS mask FROM sets
          WHERE len(items) >= 2),
splits AS (SELECT support,
             list_filter(items, lambda x: ((mask >> (list_position(items, x) - 1)) & 1) = 1)
               AS antecedents,
             list_filter(items, lambda x: ((mask >> (list_position(items, x) - 1)) & 1) = 0)
               AS consequents FROM masks),
rules AS MATERIALIZED (
  SELECT antecedents, consequents, s.support, s.support / a.support AS confidence,
         s.support / a.support / c.support AS lift,
         s.support - a.support * c.support AS leverage,
         CASE WHEN s.support < a.support
              THEN (1 - c.support) / (1 - s.support / a.support) END AS conviction
  FROM splits s JOIN sets a ON a.items = s.antecedents JOIN sets c ON c.items = s.consequents
  WHERE s.support / a.support / c.support >= 1 AND s.support / a.support >= 0.3)
"""
LISTED = "array_to_string({0}, '|') AS {0}"


def listed(df, *columns):
    return df.withColumns({c: F.concat_ws("|", c) for c in columns})


@query("frequent_itemsets", SETS + """
SELECT array_to_string(items, '|') AS items, freq, support FROM sets
""", "support")
def frequent_itemsets(star):
    return listed(itemsets(star), "items")


@query("frequent_itemsets_apriori", SETS + """
SELECT array_to_string(items, '|') AS items, freq, support FROM sets
""", "support")
def frequent_itemsets_apriori(star):
    return listed(rules.frequent_itemsets_apriori(baskets(star), SUPPORT), "items")


@query("association_rules", RULES + """
SELECT array_to_string(antecedents, '|') AS antecedents,
       array_to_string(consequents, '|') AS consequents,
       support, confidence, lift, leverage, conviction FROM rules
""", "support confidence lift leverage conviction")
def association_rules(star):
    return listed(rules.association_rules(itemsets(star), CONFIDENCE), "antecedents",
                  "consequents")


def _short(column, shown, more=""):
    return (f"array_to_string({column}[1:{shown}], ', ') || CASE WHEN len({column}) > {shown}"
            f" THEN ' +' || (len({column}) - {shown}) || '{more}' ELSE '' END")


@query("top_rules", RULES + f"""
SELECT {_short('antecedents', 2)} AS antecedent, {_short('consequents', 2)} AS consequent,
       support, confidence, lift
FROM rules ORDER BY round(lift, 9) DESC, antecedents, consequents LIMIT 10
""", "support confidence lift")
def top_rules(star):
    return rules.top_rules(rules.association_rules(itemsets(star), CONFIDENCE))


@query("movie_bundles", SETS + f"""
SELECT {_short('items', 3, ' more')} AS movies, CAST(len(items) AS INTEGER) AS size, support
FROM sets WHERE len(items) BETWEEN 2 AND 5 ORDER BY round(support, 9) DESC, items LIMIT 10
""", "support")
def movie_bundles(star):
    return rules.movie_bundles(itemsets(star))


@query("rule_subset_join", RULES + """
SELECT "userId", array_to_string(antecedents, '|') AS antecedents
FROM b JOIN (SELECT DISTINCT antecedents FROM rules) AS r ON list_has_all(items, antecedents)
""")
def rule_subset_join(star):
    found = baskets(star)
    return listed(rules.rule_subset_join(strong_rules(found), found).drop("side"), "antecedents")


@query("rule_recommend", RULES + """,
best AS (SELECT antecedents, unnest(consequents) AS item, confidence FROM rules),
s AS (SELECT "userId", item, max(confidence) AS score
      FROM b JOIN best ON list_has_all(items, antecedents) AND NOT list_contains(items, item)
      GROUP BY 1, 2)
SELECT *, CAST(row_number() OVER (PARTITION BY "userId" ORDER BY round(score, 9) DESC, item)
               AS INTEGER) AS place
FROM s QUALIFY place <= 5
""", "score")
def rule_recommend(star):
    found = baskets(star)
    return rules.rule_recommend(strong_rules(found), found)


@query("mining_summary", RULES + """
SELECT unnest(['fpgrowth', 'apriori']) AS algorithm, (SELECT count(*) FROM sets) AS itemsets,
       (SELECT count(*) FROM rules) AS rules, (SELECT n FROM size) AS transactions
""")
def mining_summary(star):
    found = baskets(star)
    return rules.mining_summary(
        found, stage(rules.frequent_itemsets(found, SUPPORT)),
        stage(rules.frequent_itemsets_apriori(found, SUPPORT)), CONFIDENCE)
