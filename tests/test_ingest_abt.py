"""From CSV exports in the original layouts to the base table (string ids, positional binding)."""

from datetime import datetime
from decimal import Decimal

from firstbasket.config import Config
from firstbasket.plans.abt import Sources, build_abt
from firstbasket.sources.ingest import load_roles

FILES = {
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
                 "c1,u1,01000,sao paulo,SP\nc2,u1,20000,rio,RJ\nc3,u2,30000,bh,MG\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
              "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n"
              "o1,c1,delivered,2018-01-01 10:00:00,,,2018-01-05 10:00:00,2018-01-10 00:00:00\n"
              "o2,c2,delivered,2018-03-01 09:00:00,,,2018-03-04 09:00:00,2018-03-09 00:00:00\n"
              "o3,c3,delivered,2018-01-02 08:00:00,,,2018-01-20 08:00:00,2018-01-15 00:00:00\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                   "o1,1,p1,s1,2018-01-03 00:00:00,100.00,10.00\no1,2,p2,s1,2018-01-03 00:00:00,50.00,5.00\n"
                   "o3,1,p3,s1,2018-01-03 00:00:00,20.00,2.00\n",
    "order_payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
                      "o1,1,credit_card,3,110.00\no1,2,voucher,1,55.00\no3,1,boleto,1,22.00\n",
    "order_reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,"
                     "review_creation_date,review_answer_timestamp\n"
                     'r1,o1,2,,"late, and\nbroken",2018-01-06 00:00:00,2018-01-07 00:00:00\n'
                     "r2,o1,5,,,2018-01-06 00:00:00,2018-01-08 12:00:00\n",
    "products": "product_id,product_category_name,a,b,c,d,e,f,g\np1,beleza_saude,1,1,1,1,1,1,1\n"
                "p2,pc_gamer,1,1,1,1,1,1,1\np3,,1,1,1,1,1,1,1\n",
    "category_translation": "product_category_name,product_category_name_english\nbeleza_saude,health_beauty\n",
    "state_median_income": "state,median_income_per_capita\nSP,1712\nMG,1224\n",
}


def test_csv_exports_to_base_table(spark, tmp_path):
    paths = {}
    for role, text in FILES.items():
        path = tmp_path / f"{role}.csv"
        path.write_text(text)
        paths[role] = str(path)
    t = load_roles(spark, paths)
    src = Sources(t["customers"], t["orders"], t["order_items"], t["order_payments"], t["order_reviews"],
                  t["products"], t["category_translation"], t["state_median_income"])
    rows = {r["customer_unique_id"]: r for r in
            build_abt(src, Config(dataset_end=datetime(2018, 8, 15))).collect()}
    u1, u2 = rows["u1"], rows["u2"]
    assert (u1["first_order_id"], u1["reordered_180d"], u1["customer_state"]) == ("o1", 1, "SP")
    assert u1["first_order_item_count"] == 2 and u1["first_order_price"] == Decimal("150.00")
    assert u1["first_order_category"] == "health_beauty"  # highest price item, translated
    assert u1["first_order_review_score"] == 5 and u1["review_comment_flag"] == 0  # latest review kept
    assert u1["primary_payment_type"] == "credit_card" and u1["used_multiple_payment_types"] == 1
    assert u1["state_median_monthly_income"] == Decimal("1712.00")
    assert u1["days_to_deliver"] == 4.0 and u1["actual_vs_estimated_delivery_days"] < 0
    assert (u2["reordered_180d"], u2["first_order_category"], u2["customer_state"]) == (0, "unknown_category", "MG")
    assert u2["actual_vs_estimated_delivery_days"] > 1
    assert t["order_reviews"].where("order_id = 'o1'").count() == 1
