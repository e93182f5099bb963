"""Fixed schemas of the reference inputs; nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _columns(text: str) -> T.StructType:
    """A schema from `name:type` entries."""
    schema = T.StructType()
    for entry in text.split():
        name, kind = entry.split(":")
        schema = schema.add(name, kind)
    return schema


CLICKS = _columns(
    "uid:long user_city:long item_id:long author_id:long item_city:long channel:integer "
    "finish:integer like:integer music_id:long device:long time:long duration_time:integer"
)

# the writer puts genres before actors
CLICKS_WITH_LISTS = T.StructType(list(CLICKS.fields)).add("genres", "string").add("actors", "string")

CLICKS_WITH_HISTORY = (
    T.StructType(list(CLICKS_WITH_LISTS.fields))
    .add("history_item_ids", "string")
    .add("history_citys", "string")
)

# leading zeros occur in the ids, so they stay text
SONGS = _columns(
    "user_id:string sm_id:string timestamp:long level:integer user_lang:string platform:string "
    "country:string gender:integer age:integer song_lang_id:integer artist_gender:integer "
    "song_quality:double song_recording_count:long song_genres:string song_create_time:long "
    "artist_country_id:integer region:string is_new:integer"
)

RATINGS = _columns(
    "user_id:long movie_id:long rating:integer timestamp:long title:string genres:string "
    "gender:string age:integer occupation:integer zip:string"
)

NEWS_CLICKS = _columns(
    "user_id:long click_article_id:long click_timestamp:long click_environment:integer "
    "click_deviceGroup:integer click_os:integer click_country:integer click_region:integer "
    "click_referrer_type:integer"
)

# fixed values: the census column names; the file has one more, leading, column
CENSUS_NAMES = (
    "age class_worker det_ind_code det_occ_code education wage_per_hour hs_college "
    "marital_stat major_ind_code major_occ_code race hisp_origin sex union_member "
    "unemp_reason full_or_part_emp capital_gains capital_losses stock_dividends "
    "tax_filer_stat region_prev_res state_prev_res det_hh_fam_stat det_hh_summ "
    "instance_weight mig_chg_msa mig_chg_reg mig_move_reg mig_same mig_prev_sunbelt "
    "num_emp fam_under_18 country_father country_mother country_self citizenship "
    "own_or_self vet_question vet_benefits weeks_worked year income_50k"
).split()
# fixed values: the census columns that are categories
CENSUS_CATEGORIES = (
    "class_worker det_ind_code det_occ_code education hs_college major_ind_code "
    "major_occ_code race hisp_origin sex union_member unemp_reason full_or_part_emp "
    "tax_filer_stat region_prev_res state_prev_res det_hh_fam_stat det_hh_summ "
    "mig_chg_msa mig_chg_reg mig_move_reg mig_same mig_prev_sunbelt fam_under_18 "
    "country_father country_mother country_self citizenship vet_question"
).split()
_CENSUS_TEXT = {*CENSUS_CATEGORIES, "marital_stat", "income_50k"}
CENSUS = T.StructType().add("row_id", "long")
for _name in CENSUS_NAMES:
    CENSUS = CENSUS.add(_name, "string" if _name in _CENSUS_TEXT else "double")

_VECTOR = T.ArrayType(T.FloatType())
VIDEO = T.StructType().add("item_id", "long").add("video_feature_dim_128", _VECTOR)
AUDIO = T.StructType().add("item_id", "long").add("audio_feature_128_dim", _VECTOR)
TITLE = (
    T.StructType()
    .add("item_id", "long")
    .add("title_features", T.MapType(T.StringType(), T.IntegerType()))
)

# fixed values: names of the face columns after the item id
FACE_NAMES = (
    "male_perc female_perc faces maleBeauty femaleBeauty faceSquare male_num femalie_num"
).split()
