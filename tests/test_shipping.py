from elsewhere import run_elsewhere


def test_planners_and_converters(sf, tmp_path):
    run_elsewhere(["chunk_plan_full", "html_to_md", "greedy_dedup", "normalised_documents", "sqlite_search", "stream_upsert", "audit_records", "bounded_crawl"], sf, tmp_path)
