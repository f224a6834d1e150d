from rillflow.plans.jobs import (
    blacklist_then_hot_ads,
    classify_levels,
    hot_ads_by_province,
    hot_ads_by_user,
    hot_items,
    hot_pages,
    login_failures,
    order_timeouts,
    page_views,
    rising_levels,
    running_page_views,
    threshold_alarm,
    unique_visitors,
    visitors_per_window,
    word_count,
)

__all__ = [
    "blacklist_then_hot_ads",
    "classify_levels",
    "hot_ads_by_province",
    "hot_ads_by_user",
    "hot_items",
    "hot_pages",
    "login_failures",
    "order_timeouts",
    "page_views",
    "rising_levels",
    "running_page_views",
    "threshold_alarm",
    "unique_visitors",
    "visitors_per_window",
    "word_count",
]
