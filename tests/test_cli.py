"""Command line: load a JSON-lines collection and profile it."""
import json
import os
import tempfile

from docnorm.__main__ import main
from docnorm.plans import load as L


def test_cli_load_and_profile(spark):
    d = tempfile.mkdtemp(prefix="cli-")
    os.makedirs(os.path.join(d, "users"))
    with open(os.path.join(d, "users", "part-0.json"), "w") as fh:
        for i in range(5):
            fh.write(json.dumps({"_id": {"$oid": f"u{i:05d}"}, "firstname": "F", "lastname": "L", "email": "e",
                                 "role": {"id": "r", "name": "R"}}) + "\n")
    main(["load", "--store", os.path.join(d, "store"), "--input", os.path.join(d, "users"), "--collection", "users"])
    assert L.Store(spark, os.path.join(d, "store")).read("lml_users", "main").count() == 5
    main(["profile", "--input", os.path.join(d, "users"), "--out", os.path.join(d, "profile")])
    assert os.path.isdir(os.path.join(d, "profile", "field_coverage"))
