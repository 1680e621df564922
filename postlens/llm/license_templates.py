"""License wording with markup, by label.

``<<beginOptional>>`` to ``<<endOptional>>`` may be missing, ``<<var;words=a-b>>`` stands for any a to
b words, all else must stand word by word. Fixed values: the wording of public licenses.
"""

from __future__ import annotations

# Phrases of the base labels.
PHRASES = {
    "mit": ("MIT License",),
    "apache": ("Apache License",),
    "gpl": ("General Public License",),
}

_WARRANTY = (
    "<<beginOptional>>IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR"
    " CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR"
    " PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,"
    " OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE"
    " POSSIBILITY OF SUCH DAMAGE.<<endOptional>>"
)
_BSD_HEAD = (
    "<<beginOptional>>Copyright <<var;words=0-20>> All rights reserved.<<endOptional>> Redistribution and use in source and binary"
    " forms, with or without modification, are permitted provided that the following conditions are met:"
    " <<beginOptional>>1.<<endOptional>> Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer. <<beginOptional>>2.<<endOptional>> Redistributions in binary form must reproduce the"
    " above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution."
)
_BSD_TAIL = (
    " THIS SOFTWARE IS PROVIDED BY <<var;words=1-20>> \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO,"
    " THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. " + _WARRANTY
)
_FREE = (
    "<<beginOptional>>This program is free software:<<endOptional>> <<beginOptional>>you can<<endOptional>> redistribute it and/or"
    " modify it under the terms of the GNU <<beginOptional>>{kind}<<endOptional>> General Public License as published by the Free"
    " Software Foundation<<beginOptional>>, either<<endOptional>> version {version}"
    "<<beginOptional>>of the License<<endOptional>><<beginOptional>>, or (at your option) any later version<<endOptional>>"
)


def _free(kind: str, version: str) -> str:
    text = _FREE.replace("{version}", version)
    optional = "<<beginOptional>>{kind}<<endOptional>> "
    return text.replace(optional, kind + " " if kind else "")


# Notices and whole texts. A label may have several.
TEMPLATES = {
    "mit": (
        "<<beginOptional>>The<<endOptional>> <<beginOptional>>MIT License<<endOptional>> <<beginOptional>>(MIT)<<endOptional>>"
        " <<beginOptional>>Copyright <<var;words=0-20>><<endOptional>>"
        " Permission is hereby granted, free of charge, to any person obtaining a copy of <<var;words=1-6>> (the \"Software\"), to"
        " deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,"
        " distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to"
        " do so, subject to the following conditions: The above copyright notice and this permission notice"
        " <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or substantial portions of"
        " the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT"
        " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."
        " <<beginOptional>>IN NO EVENT SHALL <<var;words=1-20>> BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN"
        " ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
        " DEALINGS IN THE SOFTWARE.<<endOptional>>",
        "<<var;words=0-1>> under the <<beginOptional>>terms of the<<endOptional>> MIT License",
    ),
    "isc": (
        "<<beginOptional>>ISC License<<endOptional>> <<beginOptional>>Copyright <<var;words=0-20>><<endOptional>> Permission to use,"
        " copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this software for any purpose with or without fee is hereby"
        " granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "bsd-2-clause": (_BSD_HEAD + _BSD_TAIL,),
    "bsd-3-clause": (
        _BSD_HEAD + " <<beginOptional>>3.<<endOptional>> Neither the name of <<var;words=1-12>> nor the names of"
        " <<beginOptional>>its<<endOptional>> contributors may be used to endorse or promote products derived from this software"
        " without specific prior written permission." + _BSD_TAIL,
    ),
    "zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable"
        " for any damages arising from the use of this software. Permission is granted to anyone to use this software for any"
        " purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following"
        " restrictions:",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 <<beginOptional>>(the \"License\"); you may not use this file except in"
        " compliance with the License. You may obtain a copy of the License at <<var;words=1-12>> Unless required by applicable law"
        " or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES"
        " OR CONDITIONS OF ANY KIND, either express or implied.<<endOptional>>",
    ),
    "gpl-2.0": (
        _free("", "2"),
        "licensed under the <<beginOptional>>GNU<<endOptional>> General Public License,"
        " <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2",
    ),
    "gpl-3.0": (
        _free("", "3"),
        "licensed under the <<beginOptional>>GNU<<endOptional>> General Public License,"
        " <<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 3",
    ),
    "lgpl-2.1": (_free("Lesser", "2.1"),),
    "lgpl-3.0": (_free("Lesser", "3"),),
    "agpl-3.0": (_free("Affero", "3"),),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
        " <<beginOptional>>If a copy of the MPL was not distributed with this file, You can obtain one at"
        " <<var;words=1-8>><<endOptional>>",
    ),
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use,"
        " compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,"
        " commercial or non-commercial, and by any means.",
    ),
    "cc-by-4.0": ("licensed under <<beginOptional>>a<<endOptional>> CC BY 4.0", "licensed under a Creative Commons Attribution 4.0"),
    "cc-by-sa-4.0": (
        "licensed under <<beginOptional>>a<<endOptional>> CC BY-SA 4.0",
        "licensed under a Creative Commons Attribution-ShareAlike 4.0",
    ),
    "cc-by-nc-4.0": (
        "licensed under <<beginOptional>>a<<endOptional>> CC BY-NC 4.0",
        "licensed under a Creative Commons Attribution-NonCommercial 4.0",
    ),
}
