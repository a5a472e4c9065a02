from mediacat.sources import media


def test_probe_edges(spark):
    probes = [
        '{"streams":[{"codec_type":"video","codec_name":"h264"},{"codec_type":"video","codec_name":"vp9"},'
        '{"codec_type":"audio","codec_name":"aac"}],"format":{"duration":"12.5","size":"99"}}',
        '{"streams":[],"format":{}}', "not json", '{"format":{"duration":"x","size":"7"}}', None,
    ]
    rows = media.media_info(spark.createDataFrame([(p,) for p in probes], "probe string")).collect()
    assert [(r.duration, r.size, r.video_codec, r.audio_codec, r.has_audio) for r in rows] == [
        (12.5, 99, "h264", "aac", True), (0.0, 0, None, None, False), (0.0, 0, None, None, False),
        (0.0, 7, None, None, False), (0.0, 0, None, None, False),
    ]


def test_first_success(spark):
    items = spark.createDataFrame(
        [("u", "hls", "hls", "c1"), ("u", "direct", "direct", "c2"), ("u", "failed", "hls", "c3"), ("u", "untried", "hls", "c4")],
        "author string, permlink string, route string, fetch_cid string",
    )
    attempts = spark.createDataFrame(
        [("u", "hls", 0, True, 0), ("u", "hls", 1, True, 5), ("u", "direct", 1, True, 0), ("u", "direct", 0, False, 9),
         ("u", "failed", 0, False, 1)],
        "author string, permlink string, ord int, ok boolean, size_bytes bigint",
    )
    got = {r.permlink: r.url for r in media.first_success(items, attempts, ["g0/", "g1/"]).collect()}
    assert got == {"hls": "g1/c1/manifest.m3u8", "direct": "g1/c2", "failed": None, "untried": None}
