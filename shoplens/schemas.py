"""Fixed record layouts of the input topics, in line order."""

USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, timestamp BIGINT"
ACCESS_LOG = "ip STRING, user_id STRING, timestamp BIGINT, method STRING, url STRING"
MARKETING = "user_id BIGINT, behavior STRING, channel STRING, timestamp BIGINT"
AD_CLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, timestamp BIGINT"
LOGIN = "user_id BIGINT, ip STRING, login_state STRING, timestamp BIGINT"
ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, timestamp BIGINT"
RECEIPT = "tx_id STRING, pay_channel STRING, timestamp BIGINT"


def fields(ddl: str) -> list[tuple[str, str]]:
    """``[(name, type), ...]`` of one of the layouts above."""
    return [tuple(part.split()) for part in ddl.split(",")]
