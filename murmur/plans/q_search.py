"""The search job's stages as SQL, shared by the queries that check them."""

from __future__ import annotations

from murmur.plans import fixtures as X
from murmur.plans.oracle_sql import contains_any, py_strip as sql_strip, scored_cte
from murmur.plans.q_relational import SEARCH_TEXT_SQL, TF_HOURS

SRCH = X.SEARCH

SEARCH_POST_TEXT = "lower(concat(coalesce(title, ''), ' ', coalesce(selftext, '')))"
SEARCH_CTES = [
    f"s_newest AS (SELECT * FROM items WHERE type = 'post' QUALIFY row_number() OVER "
    f"(PARTITION BY subreddit ORDER BY created_utc DESC, id) <= {SRCH.newest_per_community})",
    f"s_posts AS (SELECT * FROM s_newest WHERE created_utc >= {SRCH.as_of} - {TF_HOURS} * 3600 "
    f"AND contains({SEARCH_POST_TEXT}, '{SRCH.ticker.lower()}') AND NOT {contains_any(SEARCH_POST_TEXT, SRCH.ignore_keywords)} "
    f"AND score >= {SRCH.min_post_score} AND length(coalesce(selftext, '')) >= {SRCH.min_post_length})",
    "s_linked AS (SELECT c.post_id, count(*) AS num_comments FROM items c JOIN s_posts p ON c.post_id = p.id WHERE c.type = 'comment' GROUP BY 1)",
    f"s_comments AS (SELECT * FROM (SELECT c.* EXCLUDE (subreddit), p.subreddit, row_number() OVER "
    f"(PARTITION BY c.post_id ORDER BY c.created_utc, c.id) AS comment_rank FROM items c JOIN s_posts p ON c.post_id = p.id "
    f"WHERE c.type = 'comment') WHERE comment_rank <= {SRCH.comments_per_post} AND score >= {SRCH.min_comment_score} "
    f"AND length(coalesce(body, '')) >= {SRCH.min_comment_length})",
    "s_counts AS (SELECT post_id, count(*) AS kept FROM s_comments GROUP BY 1)",
    "s_budget AS (SELECT p.*, coalesce(l.num_comments, 0) AS num_comments, coalesce(sum(1 + coalesce(k.kept, 0)) OVER (ORDER BY p.subreddit, p.created_utc DESC, p.id "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS items_before FROM s_posts p LEFT JOIN s_counts k ON k.post_id = p.id LEFT JOIN s_linked l ON l.post_id = p.id)",
    f"s_kept AS (SELECT * FROM s_budget WHERE items_before < {SRCH.budget})",
    "s_items AS (SELECT id, type, title, selftext, body, url, num_comments, subreddit, created_utc, score, created_utc AS pc, id AS pid, "
    "0 AS is_c, 0 AS crank FROM s_kept UNION ALL SELECT c.id, c.type, c.title, c.selftext, c.body, c.url, NULL, c.subreddit, "
    "c.created_utc, c.score, p.created_utc, c.post_id, 1, c.comment_rank FROM s_comments c JOIN s_kept p ON c.post_id = p.id)",
    scored_cte("ss", "s_items", SEARCH_TEXT_SQL, where=f"{sql_strip(SEARCH_TEXT_SQL)} <> ''"),
]
