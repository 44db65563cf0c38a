"""SQL text of the derived inputs (DuckDB dialect), mirroring fixtures.py."""

QA = """
select conv_id, turn, question, answer from (
  select conv_id, turn, role, text as question,
         lead(role) over (partition by conv_id order by turn) as nrole,
         lead(text) over (partition by conv_id order by turn) as answer
  from conversations) x
where role = 'user' and nrole = 'assistant'
"""

SAMPLES = f"""
select (conv_id << 20) + turn as id, conv_id as image_id, question, answer
from ({QA}) qa
"""


def hash_value(id_expr: str, seed: int = 42) -> str:
    return f"cast('0x' || substr(md5('{seed}:' || cast({id_expr} as varchar)), 1, 8) as bigint)"


def split_case(id_expr: str) -> str:
    h = hash_value(id_expr)     # 0.8 and 0.9 of 2^32
    return f"case when {h} < 3435973837 then 'train' when {h} < 3865470567 then 'dev' else 'test' end"


DATASET = f"select *, {split_case('id')} as split from ({SAMPLES}) s"

REQUESTS = """
select (conv_id << 20) + turn as id, conv_id as image_id, text as question
from conversations where role = 'user'
"""

LOOKUP = "select page_id as image_id, url as filename from pages where page_id % 3 <> 0"

FILES = """
select distinct 'training-images/' || name as path from (
  select url as name from pages where page_id % 7 <> 0
  union all
  select printf('%012d.jpg', page_id) as name from pages where page_id % 6 = 0) f
"""

ITEM_PREDS = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
  case when l_partkey % 11 = 0 then null when l_partkey % 11 = 1 then '' else p_name end as reference_answer,
  case when l_orderkey % 5 = 0 then concat(' ', upper(p_name), ' ')
       when l_orderkey % 5 = 1 then split_part(p_name, ' ', 1) else p_name end as teacher_answer,
  case when l_orderkey % 3 = 0 then split_part(p_name, ' ', 2)
       when l_orderkey % 3 = 1 then concat(p_name, ' ', lower(p_type)) else p_name end as student_answer
from lineitem join part on l_partkey = p_partkey
"""

TRAIN_LOG = """
select user_id as run_id, event_id as step, event_id / 1000.0 as epoch, value as loss,
       case when event_id % 50 = 0 then value * 0.9 end as eval_loss, ts
from events
"""

CHECKPOINTS = """
select user_id as run_id, 'checkpoint-' || json_extract_string(props, '$.k') as name from events
"""

# Python str.strip()/str.isspace() whitespace as an RE2 class (same text as
# functions/text.py PY_WHITESPACE_CLASS).
WS = ("[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}"
      "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")


def norm(expr: str) -> str:
    """P8 in SQL: Python strip + lower."""
    return f"lower(regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g'))"


def words(expr: str) -> str:
    """Python s.split() in SQL."""
    return f"list_filter(regexp_split_to_array({expr}, '{WS}+'), lambda t: t <> '')"
