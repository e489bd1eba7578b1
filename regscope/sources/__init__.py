"""regscope.sources"""
