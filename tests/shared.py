"""What the test modules share."""

SF_DIR = "/root/testdata/sf0.001"
