"""Event schemas and warehouse contracts.

Reader schemas are declared and all-nullable; the rich schema also keeps the
fields the producers send but a narrower reader would drop.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, L, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.LongType(), T.BooleanType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


LOCATION = T.StructType([_f("country", S), _f("city", S), _f("timezone", S)])
USER_PROFILE = T.StructType([
    _f("name", S), _f("email", S), _f("age", I), _f("loyalty_tier", S), _f("location", LOCATION),
])
UTM = T.StructType([_f("utm_source", S), _f("utm_medium", S), _f("utm_campaign", S)])
ADDRESS = T.StructType([_f("street", S), _f("city", S), _f("zipcode", S), _f("country", S)])

# Pipeline A: rich clickstream event.
RICH_EVENT = T.StructType([
    _f("event_id", S), _f("user_id", I), _f("user_profile", USER_PROFILE), _f("event_type", S),
    _f("timestamp", S), _f("session_id", S), _f("page_url", S), _f("user_agent", S),
    _f("ip_address", S), _f("referrer", S), _f("device_type", S), _f("browser", S),
    _f("operating_system", S), _f("utm_parameters", UTM), _f("products", T.ArrayType(S)),
    _f("order_value", D), _f("payment_method", S), _f("product_id", S), _f("product_name", S),
    _f("product_category", S), _f("product_price", D), _f("quantity", I),
    _f("search_query", T.ArrayType(S)), _f("search_results_count", I),
    _f("shipping_address", ADDRESS), _f("order_id", S), _f("tax_amount", D),
    _f("shipping_cost", D), _f("filters_applied", T.ArrayType(S)), _f("login_method", S),
    _f("login_successful", B),
])

# Pipeline B: simple action event.
SIMPLE_EVENT = T.StructType([
    _f("user_id", S), _f("product_id", S), _f("action", S), _f("timestamp", S),
    _f("session_id", S), _f("amount", D), _f("device", S), _f("location", S),
])

ORDER_ITEM = T.StructType([_f("product_id", S), _f("quantity", I), _f("price", D)])
ORDER_CREATED = T.StructType([
    _f("order_id", S), _f("customer_id", S), _f("items", T.ArrayType(ORDER_ITEM)),
    _f("total_amount", D), _f("timestamp", S),
])
ENVELOPE = T.StructType([
    _f("event_id", S), _f("event_type", S), _f("timestamp", S), _f("data", S), _f("message_id", L),
])


class Contract:
    """A sink table contract: column → (spark type, max length, not null, default)."""

    def __init__(self, name: str, columns: list[tuple]):
        self.name = name
        self.columns = columns  # (name, type string, max_len or None, not_null, default)

    @property
    def names(self):
        return [c[0] for c in self.columns]


def _c(name, dtype, max_len=None, not_null=False, default=None):
    return (name, dtype, max_len, not_null, default)


# The warehouse tables the metrics are written to.
CONTRACTS = {
    "user_activity_detailed": Contract("user_activity_detailed", [
        _c("user_id", "int", not_null=True), _c("date", "date", not_null=True),
        _c("user_segment", "string", 20, True), _c("age_group", "string", 10, True),
        _c("total_events", "int", default=0), _c("purchase_count", "int", default=0),
        _c("add_to_cart_count", "int", default=0), _c("daily_revenue", "decimal(15,2)", default=0),
        _c("unique_sessions", "int", default=0), _c("country", "string", 100),
        _c("batch_id", "bigint")]),
    "business_metrics_realtime": Contract("business_metrics_realtime", [
        _c("event_type", "string", 50, True), _c("hour", "int", not_null=True),
        _c("minute", "int", not_null=True), _c("event_count", "int", default=0),
        _c("total_revenue", "decimal(15,2)", default=0), _c("unique_users", "int", default=0),
        _c("avg_order_value", "decimal(15,2)", default=0), _c("active_sessions", "int", default=0),
        _c("events_per_minute", "int", default=0), _c("revenue_per_minute", "decimal(15,2)", default=0),
        _c("batch_id", "bigint")]),
    "product_performance": Contract("product_performance", [
        _c("product_category", "string", 100, True), _c("product_name", "string", 200, True),
        _c("hour", "int", not_null=True), _c("view_count", "int", default=0),
        _c("cart_adds", "int", default=0), _c("purchases", "int", default=0),
        _c("revenue_generated", "decimal(15,2)", default=0), _c("avg_price", "decimal(15,2)", default=0),
        _c("conversion_rate", "decimal(5,4)", default=0),
        _c("cart_to_purchase_rate", "decimal(5,4)", default=0), _c("batch_id", "bigint")]),
    "geographic_analytics": Contract("geographic_analytics", [
        _c("country", "string", 100, True), _c("hour", "int", not_null=True),
        _c("event_count", "int", default=0), _c("revenue", "decimal(15,2)", default=0),
        _c("unique_users", "int", default=0), _c("purchases", "int", default=0),
        _c("batch_id", "bigint")]),
    "platform_analytics": Contract("platform_analytics", [
        _c("device_type", "string", 50, True), _c("browser", "string", 50, True),
        _c("operating_system", "string", 50, True), _c("hour", "int", not_null=True),
        _c("event_count", "int", default=0), _c("revenue", "decimal(15,2)", default=0),
        _c("unique_users", "int", default=0), _c("avg_purchase_value", "decimal(15,2)", default=0),
        _c("batch_id", "bigint")]),
    "real_time_metrics": Contract("real_time_metrics", [
        _c("window_start", "timestamp"), _c("window_end", "timestamp"), _c("action", "string", 50),
        _c("location", "string", 50), _c("event_count", "bigint"),
        _c("total_amount", "decimal(15,2)"), _c("unique_users", "bigint")]),
    "user_sessions": Contract("user_sessions", [
        _c("session_id", "string", 100, True), _c("user_id", "string", 50),
        _c("start_time", "timestamp"), _c("end_time", "timestamp"), _c("total_events", "int"),
        _c("total_amount", "decimal(15,2)")]),
    "article_aggregates": Contract("article_aggregates", [
        _c("article_id", "int", not_null=True), _c("daily_views", "int"),
        _c("last_updated", "timestamp")]),
    "events_summary": Contract("events_summary", [
        _c("day", "date"), _c("views", "bigint"), _c("carts", "bigint"), _c("purchases", "bigint")]),
}
