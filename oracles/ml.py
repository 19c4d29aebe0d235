"""Oracle SQL for the ML lab jobs."""

from oracles.relations import with_

SQL = {}
H = "housing"

SQL["derive_ratios"] = with_(H, """
SELECT order_id, line_no,
       round(CASE WHEN households = 0 THEN NULL ELSE total_rooms / households END, 6) AS rooms_per_household,
       round(CASE WHEN total_rooms = 0 THEN NULL ELSE total_bedrooms / total_rooms END, 6) AS bedrooms_per_room,
       round(CASE WHEN households = 0 THEN NULL ELSE population / households END, 6) AS population_per_household
FROM housing""")

SQL["rename_label"] = with_(H, "SELECT order_id, line_no, median_house_value AS label FROM housing")

_D = ["housing_median_age", "total_rooms", "total_bedrooms", "median_house_value"]
SQL["describe_columns"] = with_(H, "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, s.stat, round(s.value, 6) AS value FROM (
  SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS stat,
         unnest([CAST(count({c}) AS DOUBLE), avg({c}), stddev_samp({c}),
                 CAST(min({c}) AS DOUBLE), CAST(max({c}) AS DOUBLE)]) AS value FROM housing) s"""
    for c in _D))

SQL["global_max_min_avg"] = with_(H, """
SELECT max(housing_median_age) AS max_age, min(total_rooms) AS min_rooms,
       round(avg(median_house_value), 6) AS avg_value FROM housing""")

SQL["group_avg"] = with_(H, """
SELECT ocean_proximity, round(avg(median_house_value), 6) AS avg_value FROM housing GROUP BY 1""")
SQL["group_avg_sql"] = SQL["group_avg"]

SQL["group_count_desc"] = with_(H, """
SELECT ocean_proximity, count(*) AS count FROM housing GROUP BY 1 ORDER BY 2 DESC, 1""")

_N = ["longitude", "latitude", "housing_median_age", "total_rooms", "total_bedrooms",
      "population", "households", "median_income"]
SQL["null_counts"] = with_(H, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM housing" for c in _N))

_C = ["total_rooms", "population", "median_income", "median_house_value"]
SQL["pearson_matrix"] = with_(H, "\nUNION ALL\n".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM housing" for a in _C for b in _C))

SQL["distribution_by_target"] = with_("dflt", """
w AS (SELECT label, dflt.n_chars AS n_chars, CAST(len(regexp_split_to_array(text, '\\s+')) AS DOUBLE) AS n_words,
             CAST(len(string_split(text, chr(10))) AS DOUBLE) AS n_lines FROM dflt JOIN documents USING (doc_id)),
long AS (SELECT label, 'n_chars' AS feature, n_chars AS x FROM w UNION ALL SELECT label, 'n_words', n_words FROM w
         UNION ALL SELECT label, 'n_lines', n_lines FROM w UNION ALL SELECT label, 'chars_per_word', n_chars / n_words FROM w)
SELECT label, feature, count(*) AS n, round(avg(x), 6) AS mean, round(stddev_samp(x), 6) AS stddev, min(x) AS min,
       quantile_cont(x, 0.25) AS p25, quantile_cont(x, 0.5) AS p50, quantile_cont(x, 0.75) AS p75, max(x) AS max
FROM long GROUP BY label, feature""")

SQL["histogram_by_target"] = with_("dflt", """
SELECT label, CAST(least(floor((n_chars - lo) * 20 / (hi - lo)) + 1, 20) AS BIGINT) AS bucket, count(*) AS n
FROM dflt, (SELECT min(n_chars) AS lo, max(n_chars) AS hi FROM dflt) GROUP BY 1, 2""")

SQL["standard_scale"] = with_(H, """
SELECT order_id, line_no,
       round((median_income - avg(median_income) OVER ()) / stddev_samp(median_income) OVER (), 4)
         AS scaled
FROM housing""")

SQL["index_labels"] = with_(H, """
SELECT ocean_proximity, CAST(row_number() OVER (ORDER BY count(*) DESC, ocean_proximity) - 1 AS INTEGER)
       AS idx FROM housing GROUP BY ocean_proximity""")

SQL["linear_regression"] = with_(H, """
SELECT round(regr_slope(median_house_value, total_rooms), 4) AS coefficient,
       round(regr_intercept(median_house_value, total_rooms), 4) AS intercept FROM housing""")

SQL["rmse"] = with_(H, """
c AS (SELECT regr_slope(median_house_value, total_rooms) AS a,
             regr_intercept(median_house_value, total_rooms) AS b FROM housing)
SELECT round(sqrt(avg(power(a * total_rooms + b - median_house_value, 2))), 4) AS rmse
FROM housing, c""")

SQL["auc"] = with_("dflt", """
g AS (SELECT n_chars AS score, count(*) FILTER (WHERE label = 1) AS pos,
             count(*) FILTER (WHERE label <> 1) AS neg FROM dflt GROUP BY 1),
c AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                               AND 1 PRECEDING), 0) AS nb FROM g)
SELECT round(sum(pos * (nb + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c""")
