"""The product item as one schema; every column may be null."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Field names of the product item.
PRODUCT = """
url string, title string, site string, ranking bigint, search_term string, total_matches bigint, results_per_page bigint,
scraped_results_per_page bigint, is_single_result boolean, invalid_url boolean, redirect boolean,
shelf_description string, short_description string, long_description string, shipping boolean, shipping_speed string,
upc string, gtin string, sku string, model string, product_id string, reseller_id string, site_product_id string,
walmart_no string, wupc string, secondary_id string, brand string, department string, departments array<string>,
price string, price_amount double, price_currency string, price_highest struct<currency:string,amount:double>,
price_lowest struct<currency:string,amount:double>, special_pricing boolean, was_price double, now_price double, list_price double,
volume_measure string, price_per_volume double, not_found boolean, low_stock boolean, is_out_of_stock boolean,
is_in_store_only boolean, no_longer_available boolean, temporary_unavailable boolean, in_stock boolean, store string, zip_code string,
pdf_urls array<string>, image_url string, image_urls array<string>, image_alts array<string>, image_res array<array<int>>,
image_dimensions array<int>, zoom_image_dimensions array<int>, image_colors array<string>, video_urls array<string>, video_count bigint,
sellpoints boolean, wc_360 boolean, wc_emc boolean, wc_pdf boolean, wc_prodtour boolean, wc_video boolean,
webcollage_image_urls array<string>, webcollage_images_count bigint, webcollage_pdfs_count bigint,
webcollage_video_urls array<string>, webcollage_videos_count bigint,
_date timestamp_ntz, _redirect boolean, _response_code int, _loaded_in_seconds double,
meta struct<charset:string,canonical_url:string,browser_title:string,keywords:string,description:string,meta_tags:array<string>>,
htags struct<h1:array<string>,h2:array<string>>, bundle boolean, bullets string, details string, directions string, warnings string,
features array<string>, ingredients array<string>, specs map<string,string>, swatches array<struct<color:string,hero_image:array<string>,hero:int>>,
variants array<struct<sku:string,properties:map<string,string>,price:double,in_stock:boolean,selected:boolean,url:string,upc:string,image_url:string>>,
buyer_reviews struct<min:int,max:int,stars:map<int,bigint>,count:bigint,average:double,last_review_date:date>,
nutrition_fact_count bigint, nutrition_fact_text_health bigint, collection_count bigint, collection_availability array<boolean>,
rich_content boolean, how_to_measure boolean, questions_total bigint, questions_unanswered bigint, mta string, ugc array<string>,
in_stores boolean, in_stores_out_of_stock boolean, marketplace array<struct<name:string,price:double,currency:string,in_stock:boolean>>,
marketplace_facts struct<rows:bigint,in_stock:boolean,lowest_price:double>, marketplace_bool boolean, owned boolean, primary_seller string, seller_id string, site_online boolean, site_online_out_of_stock boolean,
temp_price_cut boolean, us_seller_id string, promotions boolean, subscribe_discount double, subscribe_price double,
screenshot string, crawl_date string
"""


def conform(items: DataFrame, ddl: str = PRODUCT) -> DataFrame:
    """Declared columns in declared order and type; missing ones become null, others are kept at the end."""
    schema = StructType.fromDDL(ddl)
    have = set(items.columns)
    declared = [
        (F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ]
    extra = [F.col(f"`{c}`") for c in items.columns if c not in set(schema.fieldNames())]
    return items.select(*declared, *extra)
