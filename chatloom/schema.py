"""Schemas of exports, clean messages and records."""

ENTITY = "struct<type:string,text:string,href:string>"
RAW = (
    "struct<id:bigint,type:string,date_unixtime:string,`from`:string,from_id:string,text:variant,"
    f"text_entities:array<{ENTITY}>,media_type:string,sticker_emoji:string,forwarded_from:string,via_bot:string>"
)
EXPORT = f"messages array<{RAW}>"
MESSAGE = "id bigint, date bigint, from_id string, `from` string, text string"
TURNS = "array<struct<role:string,content:string>>"
