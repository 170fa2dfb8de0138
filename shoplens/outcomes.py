"""Result texts.  Fixed values: consumers compare them literally."""

# order payment monitor
PAID = "payed successfully"
PAID_LATE = "payed but already timeout"
NO_CREATE = "payed but not found created log"
TIMEOUT = "timeout"

# order payment pattern; a timed-out order gets TIMEOUT followed by the end of its wait in milliseconds
PAIRED = "payId"


def click_warning(cap: int) -> str:
    return f"click over {cap}times."


def login_run_warning(times: int) -> str:
    return f"login fail {times} times"


def login_window_warning(within_s: int) -> str:
    """The text before the number of failures; " times" follows it."""
    return f"login fail in {within_s}s for "
