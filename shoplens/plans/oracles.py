"""Independent SQL for the registered queries, in DuckDB's dialect.

The inputs are derived from the tables by the views below; each query spells
its operator out in plain SQL, not in the way the Spark form computes it.
"""

from __future__ import annotations

_E = "cast(floor(epoch({})) as bigint)"
_K = "cast(json_extract_string(props,'$.k') as bigint)"



def _arriving(source: str, number: str) -> str:
    return f"""
        select *, timestamp + case {number} % 10 when 1 then 45 when 3 then 900 when 7 then 300 when 9 then 7200
                                                 else 0 end as arrival from {source}"""


def _rush(source: str, fast: int = 60) -> str:
    fast = f"(select * replace (1704067200 + cast(floor((timestamp - 1704067200) / {fast}) as bigint) as timestamp) from {source}) r"
    return _arriving(fast, "event_id")


VIEWS = {
    "user_behavior": f"""
        select user_id, {_K} as item_id, cast({_K} % 5 as int) as category_id,
               case event_type when 'view' then 'pv' when 'purchase' then 'buy'
                    when 'click' then 'cart' else 'fav' end as behavior,
               {_E.format('ts')} as timestamp, event_id
        from events""",
    "access_log": f"""
        select '10.0.0.'||cast(user_id%256 as varchar) as ip, cast(user_id as varchar) as user_id,
               {_E.format('ts')} as timestamp,
               case when event_type in ('view','click') then 'GET' else 'POST' end as method,
               case when {_K}%10=0 then '/static/app.css' else p.url end as url, event_id
        from events join pages p on p.page_id = event_id % (select count(*) from pages)""",
    "delayed_access_log": """
        select *, (timestamp + case when event_id%10=3 then 900 else 0 end)*2147483648 + event_id as arrival
        from access_log""",
    # events so many times as fast, of which some arrive late
    "rush_access_log": _rush("access_log", 480),
    "rush_user_behavior": _rush("user_behavior"),
    "rush_marketing": _rush("marketing"),
    "late_ad_click": _arriving("ad_click", "l_orderkey"),
    "marketing": f"""
        select user_id,
               case event_type when 'view' then 'BROWSE' when 'click' then 'CLICK' when 'purchase' then 'DOWNLOAD'
                    when 'signup' then 'INSTALL' else 'UNINSTALL' end as behavior,
               case user_id%3 when 0 then 'app store' when 1 then 'wechat' else 'weibo' end as channel,
               {_E.format('ts')} as timestamp, event_id
        from events""",
    "ad_click": """
        select l_suppkey as user_id,
               cast(case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end as bigint) as ad_id,
               n_name as province, 'city'||cast(l_suppkey%7 as varchar) as city,
               cast(1704067200+(l_orderkey*7+l_linenumber*11)%86400 as bigint) as timestamp,
               l_orderkey, l_linenumber, l_partkey, l_extendedprice
        from lineitem join supplier on s_suppkey=l_suppkey join nation on n_nationkey=s_nationkey""",
    "login": """
        select user_id, '10.0.0.'||cast(user_id%256 as varchar) as ip, login_state,
               1704067200+user_id*60+(seq//2)+(seq//9)*7 as timestamp, seq
        from (select l_orderkey%n4 as user_id,
                     case when l_returnflag='R' and l_linestatus='O' then 'success' else 'fail' end as login_state,
                     row_number() over(partition by l_orderkey%n4
                         order by l_partkey,l_suppkey,l_orderkey,l_linenumber,l_extendedprice)-1 as seq
              from lineitem, (select cast(count(*)//4 as bigint) as n4 from orders) q) z""",
    "order_event": f"""
        select o_orderkey as order_id, 'create' as event_type, '' as tx_id, {_E.format('o_orderdate')} as timestamp
        from orders where o_orderkey%50<>7
        union all
        select o_orderkey, 'pay', 'tx'||cast(o_orderkey as varchar),
               {_E.format('o_orderdate')}+(o_orderkey*7919)%1800
        from orders where o_orderkey%4<>0""",
    "receipt": f"""
        select 'tx'||cast(o_orderkey as varchar) as tx_id,
               case o_orderkey%3 when 0 then 'alipay' when 1 then 'wechat' else 'card' end as pay_channel,
               {_E.format('o_orderdate')}+(o_orderkey*7919)%1800+(o_orderkey*31)%13-5 as timestamp
        from orders where o_orderkey%6<>0""",
}

VIEWS["ad_click_days"] = """
        select * replace (1704067200 + (l_orderkey*1237 + l_linenumber*11003) % 169200 as timestamp) from ad_click"""

_NEEDS = {"delayed_access_log": ["access_log"], "rush_access_log": ["access_log"], "rush_user_behavior": ["user_behavior"],
          "rush_marketing": ["marketing"], "late_ad_click": ["ad_click"], "ad_click_days": ["ad_click"]}


def over(views: list[str], query: str, steps: str = "", recursive: bool = False) -> str:
    """``query`` with the named input views (and further steps) in front of it."""
    names: list[str] = []
    for view in views:
        names += [n for n in _NEEDS.get(view, []) + [view] if n not in names]
    parts = [f"{name} as ({VIEWS[name]})" for name in names]
    if steps:
        parts.append(steps)
    return f"with {'recursive ' if recursive else ''}" + ",\n".join(parts) + "\n" + query


def sliding(source: str, keys: str, size: int, slide: int, where: str) -> str:
    """Count rows per key and sliding window, one joined row per window a row lies in."""
    by = keys + ", " if keys else ""
    return f"""
        select {by}((timestamp // {slide}) - i) * {slide * 1000} + {size * 1000} as window_end, count(*) as count
        from {source}, range(0, {size // slide}) t(i)
        where {where}
        group by {by}window_end"""


_HOT_ITEMS = "hot as (" + sliding("user_behavior", "item_id", 3600, 300, "behavior='pv'") + ")"
_PAGE = "method='GET' and not regexp_matches(url, '\\.(css|js|png|ico)$')"
_HOT_PAGES = "hot as (" + sliding("access_log", "url", 600, 5, _PAGE) + ")"


# Deliveries of streams whose events arrive late: five equal spans of arrival; the watermark after each and before it.
def _arrivals(source: str, delay_ms: int) -> str:
    return f"""sliced as (
    select s.*, (arrival - low) * 5 // span as slice
    from {source} s, (select min(arrival) as low, max(arrival) - min(arrival) + 1 as span from {source}) ends),
tops as (select slice, max(timestamp) as top from sliced group by slice),
marks as (
    select i as slice, (select max(top) from tops where slice <= i) * 1000 - {delay_ms} as mark,
           (select max(top) from tops where slice < i) * 1000 - {delay_ms} as before
    from range(0, 5) t(i))"""


def in_time(source: str, keys: str, size: int, slide: int, where: str, delay_ms: int = 200, lateness_ms: int = 0,
            steps: str = "", rows: str = "sliced") -> str:
    """``accepted``: one row per event and window that was open when it came; ``hot``: counts of windows closed at the end."""
    by = keys + ", " if keys else ""
    return _arrivals(source, delay_ms) + f"""{steps},
parts as (
    select {by}((timestamp // {slide}) - i) * {slide * 1000} + {size * 1000} as window_end, slice
    from {rows}, range(0, {size // slide}) t(i) where {where}),
accepted as (
    select p.* from parts p join marks m on m.slice = p.slice
    where m.before is null or window_end - 1 + {lateness_ms} > m.before),
hot as (
    select {by}window_end, count(*) as count from accepted
    where window_end - 1 <= (select max(mark) from marks) group by {by}window_end)"""


# What a window has given out after each delivery: the first time when it is closed, then when late rows correct it.
def _versions(key: str) -> str:
    return f"""
added as (
    select {key}, window_end, greatest(slice, (select count(*) from marks where mark < window_end - 1)) as slice, count(*) as n
    from accepted where window_end - 1 <= (select max(mark) from marks) group by all),
versions as (
    select {key}, window_end, slice, cast(sum(n) over (partition by {key}, window_end order by slice) as bigint) as count
    from added)"""


_RUSH_ITEMS = in_time("rush_user_behavior", "item_id", 3600, 300, "behavior='pv'")
_RUSH_PAGES = in_time("rush_access_log", "url", 600, 5, _PAGE, 1000, 60000)
_PAGE_CHANGES = _RUSH_PAGES + "," + _versions("url")

_FIRST_SEEN = """views as (
    select user_id, (timestamp // 3600) * 3600000 + 3600000 as window_end from user_behavior where behavior='pv'),
firsts as (select user_id, min(window_end) as window_end from views group by user_id)"""
_UV_SO_FAR = """
    select 'uv' as url, w.window_end, (select count(*) from firsts f where f.window_end <= w.window_end) as count, true as close
    from (select distinct window_end from views) w"""


_HOT_PAGES_IN_TIME = f"""marked as (
    select *, max(timestamp) over (order by arrival rows between unbounded preceding and 1 preceding) as seen
    from delayed_access_log),
hot as (
    select url, ((timestamp // 5) - i) * 5000 + 600000 as window_end, count(*) as count
    from marked, range(0, 120) t(i)
    where {_PAGE} and not coalesce(((timestamp // 5) - i) * 5000 + 600000 - 1 + 60000 <= (seen - 1) * 1000, false)
    group by url, window_end)"""

_RANK_CHANGES = in_time("rush_user_behavior", "item_id", 3600, 300, "behavior='pv'", 200, 600_000) + "," + _versions("item_id") + """,
states as (
    select b.window_end, b.slice, p.item_id, cast(sum(p.n) as bigint) as cnt
    from (select distinct window_end, slice from added) b join added p on p.window_end = b.window_end and p.slice <= b.slice
    group by b.window_end, b.slice, p.item_id),
ranks as (
    select *, cast(row_number() over (partition by window_end, slice order by cnt desc, item_id) as int) as row_num from states),
moves as (
    select *, lag(item_id) over w as old_item, lag(cnt) over w as old_cnt
    from ranks where row_num <= 5 window w as (partition by window_end, row_num order by slice))"""


def _ranked(key: str, order: str = "count desc") -> str:
    return f"""ranked as (
        select window_end, cast(rank as int) as rank, {key}, count
        from (select *, row_number() over (partition by window_end order by {order}, {key}) as rank from hot) r
        where rank <= 5)"""


def text_end(column: str) -> str:
    return f"strftime(make_timestamp({column}*1000), '%Y-%m-%d %H:%M:%S') || '.0'"


def report(key: str) -> str:
    return f"""
        select window_end, 'window end: ' || {text_end('window_end')} || chr(10) ||
               string_agg('No '||rank||': '||{key}||', '||count, chr(10) order by rank) as report
        from ranked group by window_end"""


def _hours(count: str, label: str, where: str = "behavior='pv'") -> str:
    return f"""
        select '{label}' as url, (timestamp // 3600) * 3600000 + 3600000 as window_end, {count} as count
        from user_behavior where {where} group by window_end"""


_CAPPED_ON_ARRIVAL = """,
numbered as (
    select *, row_number() over (partition by user_id, ad_id, timestamp // 86400
        order by slice, timestamp, l_orderkey, l_linenumber, l_partkey, l_extendedprice) as nth from sliced)"""

_CAPPED = """numbered as (
    select *, row_number() over (partition by user_id, ad_id, timestamp // 86400
        order by timestamp, l_orderkey, l_linenumber, l_partkey, l_extendedprice) as nth from ad_click)"""

# A18 with cycles of 24 hours from the first click of a user on an ad
_CAPPED_24H = """starts as (
    select user_id, ad_id, min(timestamp) as start from ad_click_days group by user_id, ad_id
    union all
    select user_id, ad_id, start from (
        select s.user_id, s.ad_id, (select min(c.timestamp) from ad_click_days c where c.user_id = s.user_id
                                    and c.ad_id = s.ad_id and c.timestamp >= s.start + 86400) as start
        from starts s) n where start is not null),
placed as (
    select c.*, (select max(s.start) from starts s where s.user_id = c.user_id and s.ad_id = c.ad_id
                 and s.start <= c.timestamp) as start from ad_click_days c),
numbered as (
    select *, row_number() over (partition by user_id, ad_id, start
        order by timestamp, l_orderkey, l_linenumber, l_partkey, l_extendedprice) as nth from placed)"""

_P1 = """marked as (
    select *, sum(case when login_state='success' then 1 else 0 end) over (partition by user_id
        order by timestamp, seq rows between unbounded preceding and current row) as island from login),
fails as (
    select user_id, island, timestamp, row_number() over (partition by user_id, island order by timestamp, seq) as pos
    from marked where login_state <> 'success'),
ends as (
    select user_id, island - 1 as island, timestamp as stop from marked where login_state = 'success'),
walk as (
    select user_id, island, pos, timestamp, timestamp as anchor from fails where pos = 1
    union all
    select f.user_id, f.island, f.pos, f.timestamp,
           case when f.timestamp <= w.anchor + 5 then w.anchor else f.timestamp end
    from walk w join fails f on f.user_id = w.user_id and f.island = w.island and f.pos = w.pos + 1)"""


_TX = """pays as (select * from order_event where tx_id <> ''),
pairs as (
    select p.tx_id, p.order_id, p.event_type, p.timestamp as order_time, r.pay_channel, r.timestamp as receipt_time
    from pays p join receipt r on r.tx_id = p.tx_id and r.timestamp between p.timestamp - 3 and p.timestamp + 5)"""

DOCUMENTS = """select tx_id as "txId", order_id as "orderId", event_type as "eventType", order_time as "orderTime",
           pay_channel as "payChannel", receipt_time as "receiptTime",
           strftime(make_timestamp(order_time*1000000), '%Y-%m-%d') as day,
           sha256(tx_id||'|'||order_id||'|'||order_time||'|'||receipt_time) as doc_id
    from pairs"""

_MS = "select event_id, cast(floor(epoch(ts)) as bigint)*1000 + event_id%1000 as ms from events"

# A create and the row of its order right after it decide; rows of one second are ordered create, pay.
_P3 = """
    neighbours as (
        select *, lag(event_type) over w as before_type, lag(timestamp) over w as before,
               lead(event_type) over w as after_type, lead(timestamp) over w as after
        from order_event where event_type in ('create', 'pay')
        window w as (partition by order_id order by timestamp, event_type)),
    decided as (
        select order_id, case when after_type = 'pay' and after < timestamp + 900 then 'payed successfully'
                              when after_type = 'pay' and after = timestamp + 900 then 'payed but already timeout'
                              else 'timeout' end as result_state,
               not coalesce(after_type = 'pay' and after < timestamp + 900, false) as is_timeout_side,
               case when after_type = 'pay' and after <= timestamp + 900 then after else timestamp + 900 end as decided_at
        from neighbours
        where event_type = 'create' and not coalesce(after_type = 'create' and after <= timestamp + 900, false)
        union all
        select distinct order_id, 'payed but not found created log', true, timestamp from neighbours
        where event_type = 'pay' and not coalesce(before_type = 'create' and timestamp <= before + 900, false))"""

# Along the rows of a transaction, neighbours of different kinds within the interval are chained;
# every second row of a chain closes a pair with the one before it.
_J1 = """
    select tx_id, order_id, event_type, order_time, pay_channel, receipt_time from (
        select tx_id, coalesce(order_id, before.order_id) as order_id, coalesce(event_type, before.event_type) as event_type,
               coalesce(order_time, before.order_time) as order_time, coalesce(pay_channel, before.pay_channel) as pay_channel,
               coalesce(receipt_time, before.receipt_time) as receipt_time,
               row_number() over (partition by tx_id, chain order by place) as nth
        from (select *, sum(case when linked then 0 else 1 end) over (partition by tx_id order by place) as chain
              from (select *, lag(r) over w as before, row_number() over w as place,
                           coalesce((is_receipt and not lag(is_receipt) over w and moment - lag(moment) over w <= 5)
                                 or (not is_receipt and lag(is_receipt) over w and moment - lag(moment) over w <= 3), false) as linked
                    from (select *, struct_pack(order_id := order_id, event_type := event_type, order_time := order_time,
                                                pay_channel := pay_channel, receipt_time := receipt_time) as r
                          from (select tx_id, false as is_receipt, timestamp as moment, order_id, event_type,
                                       timestamp as order_time, null::varchar as pay_channel, null::bigint as receipt_time
                                from order_event where tx_id <> ''
                                union all
                                select tx_id, true, timestamp, null, null, null, pay_channel, timestamp from receipt) rows) u
                    window w as (partition by tx_id order by moment, is_receipt, order_id, pay_channel)) l) c) p
    where nth % 2 = 0"""


def sql() -> dict[str, str]:
    ub, log, ads, orders = ["user_behavior"], ["access_log"], ["ad_click"], ["order_event"]
    days = ["ad_click_days"]
    both = ["order_event", "receipt"]
    pairs = "select tx_id, order_id, event_type, order_time, pay_channel, receipt_time from pairs"
    return {
        # decoders read lines that Spark wrote from the same views
        "source_lines": over(ub, "select cast(user_id as varchar)||','||item_id||','||category_id||','||behavior||','"
                                 "||timestamp as value from user_behavior"),
        "source_multi_lines": over(both, """
            select 'OrderEvent' as topic, order_id||','||event_type||','||tx_id||','||timestamp as value from order_event
            union all
            select 'ReceiptEvent', tx_id||','||pay_channel||','||timestamp from receipt"""),
        "decode_user_behavior": over(ub, "select user_id, item_id, category_id, behavior, timestamp from user_behavior"),
        "decode_access_log": over(log, "select ip, user_id, timestamp, method, url from access_log"),
        "decode_marketing": over(["marketing"], "select user_id, behavior, channel, timestamp from marketing"),
        "decode_ad_click": over(ads, "select user_id, ad_id, province, city, timestamp from ad_click"),
        "decode_login": over(["login"], "select user_id, ip, login_state, timestamp from login"),
        "decode_order": over(orders, "select order_id, event_type, tx_id, timestamp from order_event"),
        "decode_receipt": over(["receipt"], "select tx_id, pay_channel, timestamp from receipt"),
        "decode_corrupt_lines": over(["marketing"], """
            select cast(user_id as varchar)||','||behavior||','||channel as _corrupt
            from marketing where event_id%10=1
            union all
            select 'x'||user_id||','||behavior||','||channel||','||timestamp
            from marketing where event_id%10=2"""),
        "event_time": over(ub, "select event_id, timestamp*1000 as event_ms from user_behavior"),
        "registered_view": over(ub, """select behavior, count(*) as n, min(timestamp)*1000 as first_ms
            from user_behavior group by behavior"""),
        # filters and keys
        "filter_page_view": over(ub, "select * from user_behavior where behavior='pv'"),
        "filter_get": over(log, "select * from access_log where method='GET'"),
        "filter_static": over(log, "select * from access_log where "
                                   "regexp_full_match(url, '.*') and url not like '%.css' and url not like '%.js' "
                                   "and url not like '%.png' and url not like '%.ico'"),
        "filter_uninstall": over(["marketing"], """
            select * from (select user_id, case when event_id%7=0 then null else behavior end as behavior, channel,
                                  timestamp, event_id from marketing) m
            where behavior is null or behavior <> 'UNINSTALL'"""),
        "filter_transaction": over(orders, """
            select * from (select order_id, event_type, case when order_id%9=0 then null else tx_id end as tx_id,
                                  timestamp from order_event) o
            where tx_id is null or tx_id <> ''"""),
        "constant_key": over(ub, "select 'pv' as key, count(*) as count from user_behavior where behavior='pv'"),
        "salted_counts": over(ub, "select count(*) as rows, 10 as salts, cast(1 as bigint) as in_range "
                                  "from user_behavior where behavior='pv'"),
        # windows, top-N, distinct
        "hot_item_counts": over(ub, "select * from hot", _HOT_ITEMS),
        "hot_items_top_n": over(ub, "select * from ranked", _HOT_ITEMS + ",\n" + _ranked("item_id")),
        "hot_items_coldest": over(ub, "select * from ranked", _HOT_ITEMS + ",\n" + _ranked("item_id", "count asc")),
        "hot_items_sql": over(ub, "select item_id, window_end, count as cnt, rank as row_num from ranked",
                              _HOT_ITEMS + ",\n" + _ranked("item_id")),
        "hot_items_report": over(ub, report("item_id"), _HOT_ITEMS + ",\n" + _ranked("item_id")),
        "hot_page_counts": over(log, "select * from hot", _HOT_PAGES),
        "hot_page_counts_in_time": over(["delayed_access_log"], "select * from hot", _HOT_PAGES_IN_TIME),
        "hot_pages_top_n_in_time": over(["delayed_access_log"], "select * from ranked",
                                        _HOT_PAGES_IN_TIME + ",\n" + _ranked("url")),
        "hot_pages_top_n": over(log, "select * from ranked", _HOT_PAGES + ",\n" + _ranked("url")),
        "late_page_views": over(["delayed_access_log"], f"""
            select ip, user_id, timestamp, method, url, event_id, arrival,
                   coalesce((timestamp - timestamp%5 + 600)*1000 - 1 + 60000 <= (seen - 1)*1000, false) as late
            from (select *, max(timestamp) over (order by arrival rows between unbounded preceding and 1 preceding)
                      as seen from delayed_access_log) d
            where {_PAGE}"""),
        "pv_tumbling": over(ub, _hours("count(*)", "pv")),
        "pv_salted": over(ub, _hours("count(*)", "pv")),
        "uv_exact": over(ub, _hours("count(distinct user_id)", "uv")),
        # a sketch's own value is no SQL: what is checked is that it lies within 5 % of the exact count
        "uv_hll": over(ub, _UV_SO_FAR, _FIRST_SEEN),
        "uv_hll_per_window": over(ub, f"select *, true as close from ({_hours('count(distinct user_id)', 'uv')}) h"),
        "uv_bloom_running": over(ub, """
            select 'uv' as url, window_end, row_number() over (partition by window_end order by first) as count
            from (select (timestamp // 3600)*3600000 + 3600000 as window_end, user_id, min(event_id) as first
                  from user_behavior where behavior='pv' group by 1, 2) f"""),
        "pv_per_record": over(ub, """
            select 'pv' as url, (timestamp // 3600)*3600000 + 3600000 as window_end, event_id,
                   row_number() over (partition by timestamp // 3600 order by event_id) as count
            from user_behavior where behavior='pv'"""),
        "marketing_total": over(["marketing"],
                                f"select 'total' as channel, 'total' as behavior, {text_end('window_end')} as window_end,"
                                " count from hot",
                                "hot as (" + sliding("marketing", "", 3600, 300, "behavior<>'UNINSTALL'") + ")"),
        "marketing_by_channel": over(["marketing"],
                                     f"select channel, behavior, {text_end('window_end')} as window_end, count from hot",
                                     "hot as (" + sliding("marketing", "channel, behavior", 3600, 300,
                                                          "behavior<>'UNINSTALL'") + ")"),
        "ad_clicks_capped": over(ads, "select * exclude (nth) from numbered where nth <= 100", _CAPPED),
        "ad_blacklist": over(ads, "select user_id, ad_id, 'click over 100times.' as warning_msg "
                                  "from numbered where nth = 101", _CAPPED),
        "ad_clicks_capped_24h": over(days, "select * exclude (nth, start) from numbered where nth <= 50", _CAPPED_24H, recursive=True),
        "ad_blacklist_24h": over(days, "select user_id, ad_id, 'click over 50times.' as warning_msg "
                                      "from numbered where nth = 51", _CAPPED_24H, recursive=True),
        "ad_clicks_capped_24h_counts": over(days, """
            select user_id, ad_id, count_if(nth = 1)::bigint as passed, count_if(nth = 2)::bigint as warned
            from numbered group by user_id, ad_id""", _CAPPED_24H, recursive=True),
        "ad_clicks_capped_per_hour": over(ads, """
            select user_id, ad_id, cast(sum(least(n, 3)) as bigint) as passed, cast(count_if(n > 3) as bigint) as warned
            from (select user_id, ad_id, timestamp // 3600 as hour, count(*) as n from ad_click group by 1, 2, 3) h
            group by user_id, ad_id"""),
        "ad_count_by_province": over(ads, f"select province, {text_end('window_end')} as window_end, count from hot",
                                     _CAPPED + ",\nhot as (" + sliding("numbered", "province", 3600, 300,
                                                                       "nth <= 100") + ")"),
        # patterns
        "login_fail_window": over(["login"], """
            select w.user_id, anchor as first_fail_time, max(w.timestamp) as last_fail_time,
                   'login fail in 5s for '||count(*)||' times' as warning_msg
            from walk w left join ends e on e.user_id = w.user_id and e.island = w.island
            group by w.user_id, w.island, anchor
            having count(*) >= 5 and coalesce(min(e.stop) > anchor + 5, true)""", _P1, recursive=True),
        "login_fail_consecutive": over(["login"], """
            select user_id, first as first_fail_time, timestamp as last_fail_time, 'login fail 3 times' as warning_msg
            from (select *, lag(timestamp, 2) over w as first, lag(login_state) over w as s1,
                         lag(login_state, 2) over w as s2
                  from login window w as (partition by user_id order by timestamp, seq)) l
            where login_state='fail' and s1='fail' and s2='fail' and timestamp - first < 5"""),
        "order_pay_monitor": over(orders, "select order_id, result_state, is_timeout_side from decided", _P3),
        "order_pay_matched": over(orders, """
            select order_id, 'payId' as result_state from order_event c
            where event_type='create' and exists (select 1 from order_event p where p.order_id = c.order_id
                  and p.event_type='pay' and p.timestamp >= c.timestamp and p.timestamp < c.timestamp + 300)"""),
        "order_pay_timed_out": over(orders, """
            select order_id, 'timeout'||(timestamp*1000 + 300000) as result_state from order_event c
            where event_type='create' and not exists (select 1 from order_event p where p.order_id = c.order_id
                  and p.event_type='pay' and p.timestamp >= c.timestamp and p.timestamp < c.timestamp + 300)"""),
        # joins
        "pay_receipt_matched": over(both, _J1),
        "pay_receipt_interval_join": over(both, pairs, _TX),
        "unmatched_pays": over(both, "select order_id, event_type, tx_id, timestamp from pays p "
                                     "where not exists (select 1 from pairs m where m.tx_id = p.tx_id)", _TX),
        "unmatched_receipts": over(both, "select tx_id, pay_channel, timestamp from receipt r "
                                         "where not exists (select 1 from pairs m where m.tx_id = r.tx_id)", _TX),
        # dates and validation
        "date_functions": f"""
            select event_id, ms - ms%86400000 + ms%1000 as start_of_day,
                   ms - ms%86400000 + 86399000 + ms%1000 as end_of_day,
                   ms - ms%3600000 + ms%1000 as floor_hour, ms - ms%3600000 + 3600000 + ms%1000 as next_hour,
                   strftime(make_timestamp(ms*1000), '%Y-%m-%d') as day_string,
                   {text_end('(ms - ms%1000)')} as window_end_string
            from ({_MS}) e""",
        "validation_codes": """
            select code, count(*) as n from (
                select case when user_id%11=0 then 1001
                            when value is null then 1001 when value <= 20 then 1004
                            when event_type = 'error' then 1003
                            when event_id%13=0 then 1002 else 0 end as code
                from events) e
            group by code""",
        # sinks
        "daily_documents": over(both, DOCUMENTS, _TX),
    }


def stream_sql() -> dict[str, str]:
    """Oracles of the streaming queries: the batch result, cut where the final watermark stops it."""
    ub, orders = ["user_behavior"], ["order_event"]
    both = ["order_event", "receipt"]

    def mark(source: str, delay_ms: int = 200) -> str:
        """Last watermark of a stream in milliseconds."""
        return f"(select max(timestamp)*1000 - {delay_ms} from {source})"

    def closed(source: str) -> str:
        return f"window_end <= {mark(source)}"

    both_mark = f"(select least({mark('order_event', 300)}, {mark('receipt', 300)}))"
    days = ["ad_click_days"]
    result = {
        "stream_lines_from_offset": over(ub, """
            select user_id, item_id, category_id, behavior, timestamp
            from user_behavior, (select min(timestamp) as low, max(timestamp) - min(timestamp) + 1 as span from user_behavior) ends
            where (timestamp - low) * 3 // span >= 1"""),
        "stream_hot_item_counts": over(["rush_user_behavior"], "select * from hot", _RUSH_ITEMS),
        "stream_hot_items_top_n": over(["rush_user_behavior"], "select * from ranked", _RUSH_ITEMS + ",\n" + _ranked("item_id")),
        "stream_hot_page_counts": over(["rush_access_log"], "select * from hot", _RUSH_PAGES),
        "stream_hot_pages_top_n": over(["rush_access_log"], "select * from ranked", _RUSH_PAGES + ",\n" + _ranked("url")),
        "stream_hot_items_sql": over(["rush_user_behavior"], """
            select item_id, window_end, cnt, row_num, true as added from moves
            where (item_id, cnt) is distinct from (old_item, old_cnt)
            union all
            select old_item, window_end, old_cnt, row_num, false from moves
            where old_item is not null and (item_id, cnt) is distinct from (old_item, old_cnt)""", _RANK_CHANGES),
        "stream_hot_page_changes": over(["rush_access_log"], """
            select url, window_end, true as added, count from versions
            union all
            select url, window_end, false, before
            from (select *, lag(count) over (partition by url, window_end order by slice) as before from versions) v
            where before is not null""", _PAGE_CHANGES),
        "stream_late_split": over(["rush_access_log"], f"""
            select ip, user_id, timestamp, method, url, event_id, arrival,
                   coalesce((timestamp - timestamp % 5 + 660) * 1000 - 1 <= before, false) as late
            from sliced join marks using (slice) where {_PAGE}""", _arrivals("rush_access_log", 1000)),
        "stream_pv_per_record": over(ub, """
            select 'pv' as url, window_end, row_number() over (partition by window_end) as count
            from (select (timestamp // 3600)*3600000 + 3600000 as window_end from user_behavior where behavior='pv') v"""),
        "stream_ad_blacklist_24h": over(days, "select user_id, ad_id, 'click over 50times.' as warning_msg "
                                              "from numbered where nth = 51", _CAPPED_24H, recursive=True),
        "stream_uv_hll": sql()["uv_hll"],
        "stream_uv_bloom_running": sql()["uv_bloom_running"],
        "stream_ad_clicks_capped": sql()["ad_clicks_capped"],
        "stream_ad_blacklist": sql()["ad_blacklist"],
        "stream_interval_join": sql()["pay_receipt_interval_join"],
        "stream_daily_documents": sql()["daily_documents"],
        "stream_ad_count_by_province": over(
            ["late_ad_click"], f"select province, {text_end('window_end')} as window_end, count from hot",
            in_time("late_ad_click", "province", 3600, 300, "nth <= 100", steps=_CAPPED_ON_ARRIVAL, rows="numbered")),
        "stream_marketing_total": over(
            ["rush_marketing"],
            f"select 'total' as channel, 'total' as behavior, {text_end('window_end')} as window_end, count from hot",
            in_time("rush_marketing", "", 3600, 300, "behavior<>'UNINSTALL'")),
        "stream_marketing_by_channel": over(
            ["rush_marketing"], f"select channel, behavior, {text_end('window_end')} as window_end, count from hot",
            in_time("rush_marketing", "channel, behavior", 3600, 300, "behavior<>'UNINSTALL'")),
        "stream_login_fail_window": over(["login"], f"""
            select w.user_id, anchor as first_fail_time, max(w.timestamp) as last_fail_time,
                   'login fail in 5s for '||count(*)||' times' as warning_msg
            from walk w left join ends e on e.user_id = w.user_id and e.island = w.island
                 left join (select user_id, max(timestamp) as final from login group by user_id) u
                   on u.user_id = w.user_id
            group by w.user_id, w.island, anchor
            having count(*) >= 5 and coalesce(min(e.stop) > anchor + 5, true)
               and (max(final) > anchor + 5 or (anchor + 5)*1000 <= {mark('login', 3000)})""", _P1, recursive=True),
        "stream_login_fail_consecutive": over(["login"], f"""
            select user_id, first as first_fail_time, timestamp as last_fail_time, 'login fail 3 times' as warning_msg
            from (select *, lag(timestamp, 2) over w as first, lag(login_state) over w as s1,
                         lag(login_state, 2) over w as s2
                  from login window w as (partition by user_id order by timestamp, seq)) l
            where login_state='fail' and s1='fail' and s2='fail' and timestamp - first < 5
              and timestamp*1000 <= {mark('login', 3000)}"""),
        "stream_order_pay_monitor": over(
            orders, "select order_id, result_state, is_timeout_side from decided "
                    f"where decided_at * 1000 <= {mark('order_event')}", _P3),
        "stream_order_pay_pattern": over(orders, f"""
            select order_id, case when paid then 'payId' else 'timeout'||(timestamp*1000 + 300000) end as result_state,
                   not paid as is_timeout_side
            from (select c.*, exists (select 1 from order_event p where p.order_id = c.order_id
                         and p.event_type='pay' and p.timestamp >= c.timestamp and p.timestamp < c.timestamp + 300
                         and p.timestamp*1000 <= {mark('order_event')}) as paid
                  from order_event c where event_type='create') x
            where paid or (timestamp + 300)*1000 <= {mark('order_event')}"""),
        "stream_reconcile": over(both, f"""
            select 'matched' as outcome, tx_id, order_id, event_type, order_time, pay_channel, receipt_time from pairs
            union all
            select 'unmatched-pay', tx_id, order_id, event_type, timestamp, null, null from pays p
            where not exists (select 1 from pairs m where m.tx_id = p.tx_id) and (timestamp + 5)*1000 <= {both_mark}
            union all
            select 'unmatched-receipt', tx_id, null, null, null, pay_channel, timestamp from receipt r
            where not exists (select 1 from pairs m where m.tx_id = r.tx_id)
              and (timestamp + 3)*1000 <= {both_mark}""", _TX),
    }
    for name, count, label in [("pv_tumbling", "count(*)", "pv"), ("pv_salted", "count(*)", "pv"),
                               ("uv_exact", "count(distinct user_id)", "uv")]:
        result["stream_" + name] = over(
            ub, f"select * from ({_hours(count, label)}) h where " + closed("user_behavior"))
    return result
