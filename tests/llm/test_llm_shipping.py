from elsewhere import run_elsewhere


def test_operators(sf, tmp_path):
    run_elsewhere(["op1_best_fit_packing", "op2_quality_classifier", "op3_html_extraction", "op4_lm_scoring", "op6_decontamination", "op7_language_id", "op8_simhash", "op9_warc", "op10_quality_rules", "op11_fill_in_middle", "op12_conversation_repair", "op13_sentencepiece"], sf, tmp_path)
