"""Declared shapes of tables, payloads and messages. Jobs never infer a schema."""

from __future__ import annotations

# --- API payloads ---------------------------------------------------------
IMAGES = "images array<struct<url:string,height:int,width:int>>"

ARTIST = f"id string, name string, followers struct<total:bigint>, genres array<string>, popularity int, {IMAGES}"
ARTIST_SEARCH = (
    "artists struct<items:array<struct<id:string,name:string,followers:struct<total:bigint>,genres:array<string>,"
    "popularity:int,images:array<struct<url:string,height:int,width:int>>>>>"
)
ALBUM_PAGE = (
    "items array<struct<id:string,name:string,release_date:string,album_type:string,total_tracks:int,"
    "images:array<struct<url:string,height:int,width:int>>>>, next string, offset int, limit int, total int"
)
TRACK_PAGE = (
    "items array<struct<id:string,name:string,duration_ms:int,track_number:int,preview_url:string,explicit:boolean>>, "
    "next string, offset int, limit int, total int"
)
SONG_SEARCH = "hits array<struct<result:struct<id:bigint,title:string>>>"
SONG = (
    "id bigint, title string, primary_artist struct<id:bigint,name:string>, "
    "producer_artists array<struct<id:bigint,name:string>>, "
    "custom_performances array<struct<label:string,artists:array<struct<id:bigint,name:string>>>>, "
    "description struct<html:string>"
)
AUDIO_FEATURES = (
    "audio_features array<struct<id:string,danceability:double,energy:double,key:int,loudness:double,mode:int,"
    "speechiness:double,acousticness:double,instrumentalness:double,liveness:double,valence:double,tempo:double,"
    "duration_ms:int,time_signature:int>>"
)

# --- catalog tables -------------------------------------------------------
STAMPS = "created_at timestamp_ntz, updated_at timestamp_ntz"
ARTISTS = (
    "artist_id string, spotify_id string, name string, followers bigint, popularity int, image_url string, "
    f"genres array<string>, {STAMPS}"
)
ALBUMS = (
    "album_id string, spotify_id string, artist_id string, name string, release_date date, cover_url string, "
    f"album_type string, total_tracks int, {STAMPS}"
)
TRACKS = (
    "track_id string, spotify_id string, album_id string, name string, duration_ms int, popularity int, "
    f"track_number int, preview_url string, explicit boolean, metadata map<string,string>, {STAMPS}"
)
NORMALIZED_TRACKS = "artist_id string, normalized_name string, representative_track_id string, created_at timestamp_ntz"
PRODUCERS = (
    "producer_id string, normalized_name string, name string, email string, image_url string, "
    "instagram_handle string, instagram_bio string, metadata map<string,string>, enriched_at timestamp_ntz, "
    f"social_links struct<twitter:string,instagram:string,spotify:string,website:string>, {STAMPS}"
)
TRACK_PRODUCERS = (
    "track_id string, producer_id string, confidence decimal(5,4), source string, created_at timestamp_ntz"
)

# --- queues and logs ------------------------------------------------------
QUEUE_MESSAGE = (
    "msg_id bigint, queue_name string, enqueued_at timestamp, vt timestamp, read_ct int, message string"
)
QUEUE_REGISTRY = "queue_name string, display_name string, description string, active boolean, updated_at timestamp_ntz"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
