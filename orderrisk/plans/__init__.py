"""End-to-end jobs: build the mart, train, predict, report, explore, explain, stress."""
