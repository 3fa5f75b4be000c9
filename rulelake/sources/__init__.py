"""rulelake.sources"""
