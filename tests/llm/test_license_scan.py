from moodlake.llm import license_scan as L


def test_rules_take_sentences_in_order(spark):
    bsd2 = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
            "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
            "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
            "materials provided with the distribution.")
    bsd3 = bsd2 + (" Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission.")
    texts = [bsd2, bsd3, "Words.\nLicensed under CC BY-NC 4.0.", "Released under the MIT License. Released under the MIT License.",
             "The MIT License is short.", None, "", "x " * 50000 + "\nAll rights reserved.",
             "Licensed under the Apache License, Version 2.0.\nAll Rights Reserved!", "A LICENSED thing"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.licenses, r.n_sentences) for r in L.scan_licenses(docs).collect()}
    assert got == {0: ("BSD-2-Clause", 3), 1: ("BSD-3-Clause", 4), 2: ("CC-BY-NC-4.0", 1), 3: ("MIT", 2), 4: ("", 0), 5: ("", 0),
                   6: ("", 0), 7: ("Proprietary", 1), 8: ("Apache-2.0, Proprietary", 2), 9: ("", 0)}


def test_equals_sql_on_odd_rows(odd_docs, odd_rows):
    import duckdb
    import pandas as pd

    con = duckdb.connect()
    con.register("documents", pd.DataFrame(odd_rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64"}))
    want = sorted(con.execute(L.scan_sql()).fetchall(), key=str)
    assert sorted([tuple(r) for r in L.scan_licenses(odd_docs).collect()], key=str) == want


def test_plan_is_one_narrow_pass(odd_docs, no_docs):
    plan = L.scan_licenses(odd_docs.coalesce(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Aggregate" not in plan and "Join" not in plan
    assert L.scan_licenses(no_docs).count() == 0
