"""Small hand-made sources: all-text staging tables as the files would deliver them."""

from parcelmart.sources.staging import COLUMNS, text_schema


def table(spark, name, rows):
    """Rows given as dicts; columns left out are empty text."""
    columns = list(COLUMNS[name])
    return spark.createDataFrame([tuple(row.get(c, "") for c in columns) for row in rows], text_schema(name))


def order(order_id, purchased, status="delivered", customer=None, approved="", carrier="", delivered="", estimated=""):
    return {
        "order_id": order_id,
        "customer_id": customer or f"c-{order_id}",
        "order_status": status,
        "order_purchase_timestamp": purchased,
        "order_approved_at": approved,
        "order_delivered_carrier_date": carrier,
        "order_delivered_customer_date": delivered,
        "order_estimated_delivery_date": estimated or "2018-02-01 00:00:00",
    }


def customer(order_id, person, city="são paulo", state="sp", zip_code="01000"):
    return {
        "customer_id": f"c-{order_id}",
        "customer_unique_id": person,
        "customer_zip_code_prefix": zip_code,
        "customer_city": city,
        "customer_state": state,
    }


def line(order_id, number, product="p1", seller="s1", price="10.00", freight="2.00"):
    return {
        "order_id": order_id,
        "order_item_id": str(number),
        "product_id": product,
        "seller_id": seller,
        "price": price,
        "freight_value": freight,
    }


def payment(order_id, sequential, kind="boleto", installments="1", value="12.00"):
    return {
        "order_id": order_id,
        "payment_sequential": str(sequential),
        "payment_type": kind,
        "payment_installments": installments,
        "payment_value": value,
    }


def review(order_id, score, answered="", review_id=None):
    return {
        "review_id": review_id or f"r-{order_id}-{score}",
        "order_id": order_id,
        "review_score": str(score),
        "review_answer_timestamp": answered,
    }


PRODUCTS = [
    {"product_id": "p1", "product_category_name": "livros", "product_weight_g": "2.5", "product_length_cm": "10",
     "product_height_cm": "2", "product_width_cm": "5"},
    {"product_id": "p2", "product_category_name": "pecas", "product_weight_g": "2.4"},
    {"product_id": "p3"},
]
TRANSLATION = [{"product_category_name": "livros", "product_category_name_english": "books"}]
SELLERS = [
    {"seller_id": "s1", "seller_zip_code_prefix": "1", "seller_city": " d'oeste ", "seller_state": " rj "},
    {"seller_id": "s2", "seller_zip_code_prefix": "2", "seller_city": "rio", "seller_state": "sp"},
]


def sources(spark, orders, customers=None, items=(), payments=(), reviews=(), products=PRODUCTS, sellers=SELLERS):
    if customers is None:
        customers = [customer(o["order_id"], f"person-{o['order_id']}") for o in orders]
    given = {
        "customers": customers, "sellers": sellers, "products": products, "category_translation": TRANSLATION,
        "orders": orders, "order_items": items, "order_payments": payments, "order_reviews": reviews,
    }
    return {name: table(spark, name, rows) for name, rows in given.items()}
