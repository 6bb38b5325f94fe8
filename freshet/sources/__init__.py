"""freshet.sources"""
