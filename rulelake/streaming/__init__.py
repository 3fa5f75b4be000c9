"""rulelake.streaming"""
